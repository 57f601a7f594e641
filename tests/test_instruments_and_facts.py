import pytest
from conftest import CONTROL, NAME, TICKER, TRADES, collect, events_frame
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.operators import enrichment, facts, instruments as i


def control(*items, **members):
    import json

    return json.dumps({"jsonrpc": "2.0", "id": 2, "result": list(items), **members})


def creation(data, channel="instrument.creation.option.BTC"):
    import json

    return json.dumps({"params": {"channel": channel, "data": data}})


def latest(spark, controls, creations=()):
    listed = i.listed_instruments(events_frame(spark, [("control", c) for c in controls]))
    rows = listed
    if creations:
        rows = i.all_instruments(
            listed, i.created_instruments(events_frame(spark, [("instrument_creation", c) for c in creations]))
        )
    return {r["instrument_name"]: r for r in collect(i.latest_instruments(rows))}


def test_last_write_wins(spark):
    got = latest(
        spark,
        [control({"instrument_name": "A", "strike": 1.0}, {"instrument_name": "A", "strike": 2.0}),
         control({"instrument_name": "B", "kind": "old"}), control({"instrument_name": "B"})],
        [creation({"instrument_name": "A", "strike": 3}), creation({"instrument_name": "C"})],
    )
    assert got["A"]["strike"] == "3"
    # The whole row is replaced, so a field missing from the last write is null.
    assert got["B"]["kind"] is None
    assert set(got) == {"A", "B", "C"}
    assert list(got["A"]) == schemas.INSTRUMENTS.names


def test_instrument_fields_and_skipped_elements(spark):
    got = latest(
        spark,
        [CONTROL, control("ack", 5, None, [1], {"kind": "x"}, {"instrument_name": 7}, '{"instrument_name":"text"}',
                          {"instrument_name": "D", "instrument_id": 5.0, "is_active": "true", "state": {"a": 1},
                           "tick_size": 0.00001, "price_index": False, "contract_size": 10}),
         '{"result":{"instrument_name":"E"}}', '{"result":"ok"}'],
    )
    assert set(got) == {NAME, "D"}
    d = got["D"]
    assert (d["instrument_id"], d["is_active"], d["state"], d["tick_size"]) == (None, None, None, "0.00001")
    assert (d["price_index"], d["contract_size"]) == ("false", "10")
    assert got[NAME]["creation_timestamp"] == 1771200000000


def test_creation_data_falls_back_to_the_top_level(spark):
    got = latest(spark, [], ['{"data":{"instrument_name":"A"}}', '{"params":{"data":null},"data":{"instrument_name":"B"}}',
                             '{"params":{"data":[1]},"data":{"instrument_name":"C"}}'])
    assert set(got) == {"A"}


# Every kind with every currency, listed, delisted and without a word on it.
MIXED = [
    {"instrument_name": f"{currency}:{kind}:{active}", "kind": kind, "base_currency": currency}
    | ({} if active is None else {"is_active": active})
    for currency in ("BTC", "SOL")
    for kind in ("option", "future", "spot", "option_combo")
    for active in (True, False, None)
]


def test_discovery(spark):
    extra = [{"kind": "option", "product_group": "BTC", "base_currency": "USDC", "instrument_name": "G"},
             {"base_currency": "BTC", "instrument_name": "nokind"}, {"kind": "option", "base_currency": "BTC"}]
    events = events_frame(spark, [("control", control(*MIXED)), ("control", control(*extra)), ("control", "junk")])
    names = [r["instrument_name"] for r in i.discovered_instruments(events, keep=["line_no"]).orderBy("line_no", "pos").collect()]
    assert names == ["BTC:option:True", "BTC:option:None", "BTC:future:True", "BTC:future:None", "G"]
    with pytest.raises(ValueError):
        i.discovered_instruments(events, [])


def test_created_names(spark):
    rows = [
        creation({"kind": "option", "base_currency": "BTC", "instrument_name": "yes"}),
        creation({"instrument_name": "bare"}),
        creation({"kind": "option", "base_currency": "ETH", "instrument_name": "eth"}, "instrument.creation.option.ETH"),
        creation({"kind": "spot", "instrument_name": "spot"}),
        creation({"kind": "option", "instrument_name": "state"}, "instrument.state.option.BTC"),
        '{"data":{"instrument_name":"nochannel"}}',
        "junk",
    ]
    events = events_frame(spark, [("instrument_creation", r) for r in rows])
    assert {r[0] for r in i.newly_created_instruments(events).collect()} == {"yes", "bare"}


def test_known_and_unknown_names(spark):
    names = spark.createDataFrame([("a",), ("b",), ("a",)], "instrument_name string")
    known = spark.createDataFrame([("b",)], "instrument_name string")
    assert i.distinct_instruments(names).count() == 2
    assert [r[0] for r in i.unknown_instruments(names, known).collect()] == ["a"]


def test_trade_shapes(spark):
    one = '{"instrument_name":"A","price":0.5}'
    shapes = {
        "[%s,%s]" % (one, one): 2,
        one: 1,
        '["x",5,null,[1],[%s],%s,{"instrument_name":5},{"price":1}]' % (one, one): 1,
        '["{\\"instrument_name\\":\\"A\\"}",%s]' % one: 1,
        '"[{}]"': 0,
        "null": 0,
        "5": 0,
        "[]": 0,
    }
    for data, expected in shapes.items():
        events = events_frame(spark, [("trades", '{"params":{"channel":"trades.A.raw","data":%s}}' % data)])
        assert facts.trade_rows(events).count() == expected, data
    top_level = events_frame(spark, [("trades", '{"data":[%s]}' % one)])
    [row] = collect(facts.trade_rows(top_level))
    assert row["subscription_channel"] == "trades" and row["price"] == "0.5"


def test_ticker_is_sparse_and_typed(spark):
    payload = (
        '{"params":{"channel":5,"data":{"instrument_name":"A","timestamp":"7","mark_price":"0.1","stats":[],'
        '"greeks":{"delta":-0.0,"vega":1E-9},"last_price":null}}}'
    )
    [row] = collect(facts.ticker_rows(events_frame(spark, [("incremental_ticker", payload)])))
    assert row["subscription_channel"] == "incremental_ticker"
    assert (row["ticker_timestamp"], row["mark_price"], row["stats_volume"]) == (None, "0.1", None)
    assert (row["delta"], row["vega"], row["last_price"]) == ("-0.0", "1e-9", None)
    dropped = ['{"params":{"data":{"instrument_name":5}}}', '{"params":{"data":[]}}', "{}"]
    assert facts.ticker_rows(events_frame(spark, [("incremental_ticker", p) for p in dropped])).count() == 0


def test_join_strategies_agree(spark, capsys):
    events = events_frame(spark, [("trades", TRADES)] * 3 + [("trades", TRADES.replace(NAME, "other"))])
    rows = facts.trade_rows(events, keep=["line_no"])
    terms = i.latest_instruments(i.listed_instruments(events_frame(spark, [("control", CONTROL)])))
    results = []
    for options in ({}, {"strategy": "salted", "salt_by": ["line_no"]}, {"broadcast_rows": 0}):
        joined = enrichment.attach_terms(rows, terms, **options)
        results.append(sorted(map(str, collect(enrichment.in_schema_order(joined, schemas.DERIVATIVES_TRADES)))))
        joined.explain()
    assert results[0] == results[1] == results[2] and len(results[0]) == 4
    plans = capsys.readouterr().out.split("== Physical Plan ==")[1:]
    assert "BroadcastHashJoin" in plans[0]
    with pytest.raises(ValueError):
        enrichment.attach_terms(rows, terms, strategy="other")


def test_ticker_joined_to_terms(spark):
    terms = i.latest_instruments(i.listed_instruments(events_frame(spark, [("control", CONTROL)])))
    unknown = TICKER.replace(NAME, "other")
    rows = facts.ticker_rows(events_frame(spark, [("incremental_ticker", TICKER), ("incremental_ticker", unknown)]))
    got = {r["instrument_name"]: r for r in collect(enrichment.attach_terms(rows, terms))}
    assert got[NAME]["strike"] == "95000.0" and got[NAME]["settlement_period"] == "week"
    assert got["other"]["strike"] is None and got["other"]["mark_price"] == "0.0177"


def test_only_heavy_keys_are_salted(spark, capsys):
    """A shuffle join in which the terms of the heavy key alone are repeated, also for keys of two columns and null keys."""
    names = [f"i{n}" for n in range(400)] + [None]
    facts = [("hot", 1, n) for n in range(3_000)] + [(names[n % 401], 1, n) for n in range(1_200)]
    terms = [(name, 1, f"kind of {name}") for name in ("hot", *names[:300])]
    terms = spark.createDataFrame(terms, "instrument_name string, day int, kind string")
    for name in schemas.TERM_COLUMNS:
        if name != "kind":
            terms = terms.withColumn(name, F.lit(None).cast("string"))
    facts = spark.createDataFrame(facts, "instrument_name string, day int, line_no int").repartition(4)
    keys = ["instrument_name", "day"]
    assert enrichment.heavy_keys(facts, keys) == ["3:hot|1:1"]
    joined = enrichment.attach_terms(facts, terms, keys, strategy="salted", salt_by=["line_no"])
    joined.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    expected = facts.join(terms, keys, "left").select(*joined.columns)
    assert joined.exceptAll(expected).count() == 0 and joined.count() == facts.count() == 4_200
    spread = enrichment.salted_left_join(facts, terms, keys, ["line_no"])
    repeated = spread.select("instrument_name").where("instrument_name = 'hot'").count()
    assert repeated == 3_000
