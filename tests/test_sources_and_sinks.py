import base64
import datetime as dt
import json
import os

import pytest
from conftest import DAY, TRADES, collect, compress, envelope, events_frame, write_raw
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.operators import inspection, quality
from tapeloom.plans.capture import capture
from tapeloom.session import materialize, scratch_dir, shared_dir
from tapeloom.sinks import events as sink
from tapeloom.sinks.capture_files import write_capture_files
from tapeloom.sources import feeds, listing, raw_capture as raw

AT = dt.datetime(2026, 6, 29, 23, 59, 59, 999000, tzinfo=dt.timezone.utc)


def messages(spark, *rows):
    schema = "exchange string, symbol string, channel string, connection_id string, text string, binary binary"
    return spark.createDataFrame(rows, schema)


def test_line_order_and_file_columns(spark, tmp_path):
    lines = [envelope("trades", str(n)) for n in range(50)]
    write_raw(tmp_path, "trades", lines[:25])
    write_raw(tmp_path, "trades", lines[25:], append=True)
    files = raw.list_raw_files(spark, str(tmp_path), [DAY, DAY + dt.timedelta(days=1)])
    assert [(f.channel, f.date) for f in files] == [("trades", DAY)]
    for spread in (False, True):
        read = raw.read_raw_events(spark, files, spread=spread)
        rows = collect(read.orderBy("line_no"))
        assert [r["payload_text"] for r in rows] == [str(n) for n in range(50)]
        assert {r["date"] for r in rows} == {DAY}
    [counted] = collect(raw.count_by_file(raw.read_raw_lines(spark, files)))
    assert counted["lines"] == 50


def test_only_wanted_channels_and_days_are_listed(spark, tmp_path):
    for channel in ("trades", "control", "instrument_state"):
        for shift in (0, 1):
            write_raw(tmp_path, channel, [], day=DAY + dt.timedelta(days=shift))
    files = raw.list_raw_files(spark, str(tmp_path), [DAY])
    assert sorted((f.channel, f.date) for f in files) == [("control", DAY), ("trades", DAY)]
    raw.require_files(files, [DAY], str(tmp_path))
    with pytest.raises(FileNotFoundError):
        raw.require_files(files, [DAY, DAY + dt.timedelta(days=5)], str(tmp_path))


def test_envelope_verdicts(spark):
    good = json.dumps(envelope("trades", None, payload_base64="AA=="))
    lines = [good, "x", json.dumps({"received_mts": 1}), json.dumps(envelope("t", "p", mts=1.5))]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert [r["envelope_ok"] for r in raw.parse_envelopes(df, on_bad="keep").collect()] == [True, False, False, False]
    assert raw.text_events(raw.parse_envelopes(df.limit(1))).count() == 0


def test_envelopes_of_text_and_binary_frames(spark):
    built = raw.build_envelopes(
        messages(spark, ("bitfinex", "tBTCUSD", "trades", "c", '{"event":"test"}', None),
                 ("bitfinex", "tBTCUSD", "trades", "c", None, bytearray(b"\x00\xff"))), F.lit(AT))
    first, second = [json.loads(r["value"]) for r in raw.envelope_lines(built).collect()]
    assert first == {
        "received_at": "2026-06-29T23:59:59.999Z", "received_mts": 1782777599999, "exchange": "bitfinex",
        "symbol": "tBTCUSD", "channel": "trades", "connection_id": "c", "payload_text": '{"event":"test"}',
    }
    assert "payload_text" not in second and base64.b64decode(second["payload_base64"]) == b"\x00\xff"


def test_two_sessions_append_and_route(spark, tmp_path):
    root = str(tmp_path / "landed")
    sub = '{"params":{"channel":"trades.A.raw","data":[]}}'
    capture(messages(spark, ("deribit", "BTC", "x", "c", sub, None), ("hibachi", "BTC/USDT-P", "market_data", "h", "[]", None)), root, F.lit(AT))
    capture(messages(spark, ("deribit", "BTC", "x", "c", sub, None), ("deribit", "BTC", "x", "c", None, bytearray(b"1"))), root, F.lit(AT))
    stored = raw.read_landed_events(spark, root)
    counts = {(r["exchange"], r["symbol"], r["channel"]): r["messages"] for r in raw.count_by_feed(stored).collect()}
    assert counts == {("deribit", "BTC", "trades"): 2, ("deribit", "BTC", "control"): 1, ("hibachi", "BTC/USDT-P", "market_data"): 1}
    assert {r["channel"]: r["events"] for r in raw.count_by_channel(stored).collect()} == {"trades": 2, "market_data": 1}
    assert {str(r["date"]) for r in stored.collect()} == {"2026-06-29"}
    assert os.path.isdir(f"{root}/exchange=deribit/symbol=BTC/channel=trades/date=2026-06-29")


def test_message_limit_per_feed(spark, tmp_path):
    rows = [("a", "s", "c", f"{n:02d}", "[]", None) for n in range(20)] + [("b", "s", "c", "00", "[]", None)]
    for limit, expected in ((3, 4), (2_000, 21)):
        root = str(tmp_path / f"l{limit}")
        capture(messages(spark, *rows), root, F.lit(AT), max_messages=limit, order=("connection_id",))
        assert raw.read_landed_events(spark, root).count() == expected


def test_writes_by_channel(spark, tmp_path):
    events = events_frame(spark, [("a", "{}"), ("b", "{}"), ("b", "{}"), ("c", "{}")])
    roots = {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")}
    with pytest.raises(ValueError, match="channels c"):
        sink.append_by_channel(events, roots)
    assert not os.path.exists(roots["a"])
    sink.append_by_channel(events, roots, rest=str(tmp_path / "rest"))
    assert [r["channel"] for r in raw.read_landed_events(spark, str(tmp_path / "rest")).collect()] == ["c"]
    assert raw.read_landed_events(spark, roots["b"]).count() == 2
    assert collect(sink.lost_channels(events, roots)) == [{"channel": "c", "messages": 1}]


def test_feed_catalogue(spark):
    assert len(feeds.feed_rows(["bitfinex"])) == 2
    extended = feeds.feed_rows(["extended"])
    assert [r[3] for r in extended] == ["orderbook", "trades", "funding", "mark_price", "index_price", "orderbook", "trades"]
    assert len(feeds.feed_rows(schemas.DEFAULT_VENUES)) == 5
    assert len(feeds.feed_rows(["deribit", "deribit"])) == 2
    [hibachi] = collect(feeds.feed_catalogue(spark, ["hibachi"]))
    assert len(hibachi["topics"]) == 6 and hibachi["connection_id"] == "hibachi-BTC/USDT-P-market_data"
    for venues, symbols in ((["x"], None), ([], None), (["bitfinex"], {"bitfinex": ""})):
        with pytest.raises(ValueError):
            feeds.feed_rows(venues, symbols)


def test_capture_arguments():
    quality.check_capture_arguments(schemas.VENUES)
    for bad in ({"venues": []}, {"venues": ["deribit"], "kinds": []}, {"venues": ["deribit"], "trades_interval": "1s"},
                {"venues": ["deribit"], "max_messages": 0}):
        with pytest.raises(ValueError):
            quality.check_capture_arguments(**bad)


def test_listing_and_samples(spark, tmp_path):
    old = write_raw(tmp_path, "control", [envelope("control", "{}")])
    new = write_raw(tmp_path, "trades", ["", *[envelope("trades", TRADES if n else "text") for n in range(8)]])
    flat = tmp_path / "flat.jsonl.zst"
    flat.write_bytes(compress([json.dumps(envelope("trades", "1"))]))
    (tmp_path / "other.txt").write_text("x")
    for age, path in enumerate((new, old, flat)):
        os.utime(path, (1_800_000_000 - age, 1_800_000_000 - age))
    files = listing.capture_files(spark, str(tmp_path))
    rows = collect(inspection.recent_files(files))
    assert [(r["exchange"], r["symbol"], r["channel"]) for r in rows] == [
        ("deribit", "btc", "trades"), ("deribit", "btc", "control"), (None, None, None)]
    assert rows[0]["size_mb"] == os.path.getsize(new) / 1024 / 1024
    assert inspection.recent_files(files, 2).count() == 2
    assert inspection.newest_file(files).first()["path"].endswith("btc_trades_26-06-29.jsonl.zst")
    assert {r["channel"] for r in inspection.newest_per_exchange(files).collect()} == {"trades", None}
    assert inspection.files_of(files, "deribit", "btc").count() == 2 and inspection.files_of(files, "x").count() == 0
    sample = collect(inspection.newest_sample(spark, str(tmp_path), 3).select("payload_text", F.schema_of_variant("payload").alias("t")))
    assert len(sample) == 3
    assert sample[0] == {"payload_text": "text", "t": "STRING"} and sample[1]["t"].startswith("OBJECT")
    assert len(inspection.recent_samples(spark, str(tmp_path))) == 3
    assert inspection.exchange_sample(spark, str(tmp_path), "deribit").count() == 5
    assert inspection.exchange_sample(spark, str(tmp_path), "other") is None
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        inspection.newest_sample(spark, str(tmp_path / "empty"))


def test_listing_does_not_read_contents(spark, tmp_path, capsys):
    write_raw(tmp_path, "trades", [envelope("trades", "1")])
    listing.capture_files(spark, str(tmp_path)).explain()
    assert "content" not in capsys.readouterr().out.split("ReadSchema")[1]


def test_expand_payload_text(spark):
    df = spark.createDataFrame([('{"a":1}',), ("raw",), (None,), ("5",)], "payload_text string")
    rows = inspection.expand_payload_text(df).select(F.col("payload").cast("string").alias("p"), F.schema_of_variant("payload").alias("t"))
    assert [tuple(r) for r in rows.collect()] == [('{"a":1}', "OBJECT<a: BIGINT>"), ("raw", "STRING"), (None, None), ("5", "BIGINT")]
    plain = spark.range(1)
    assert inspection.expand_payload_text(plain) is plain


def test_payload_quality(spark):
    events = events_frame(spark, [("c", "{}"), ("c", "x"), ("c", '{"id":1,"error":{"code":3}}'), ("c", "[1]"), ("c", '{"a":1')])
    good, bad = quality.split_bad_payloads(events)
    assert good.count() == 3 and {r["payload_text"] for r in bad.collect()} == {"x", '{"a":1'}
    assert [r["problem"] for r in quality.payload_verdicts(events).orderBy("line_no").collect()] == [
        None, "invalid JSON", "error response", None, "invalid JSON"]
    assert [r["error"] for r in quality.error_responses(events).collect()] == ['{"code":3}']
    with pytest.raises(Exception, match="required column channel is null"):
        quality.check_required(events.withColumn("channel", F.lit(None).cast("string")), schemas.ENVELOPE).collect()


def test_scratch_is_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured and scratch_dir(spark, "x").startswith(configured)
    assert materialize(spark, spark.range(3).toDF("n"), "m").count() == 3


def test_capture_files_are_written_in_order_and_replaced(spark, tmp_path):
    root = str(tmp_path / "archive")
    rows = [("trades", json.dumps({"n": n})) for n in range(50)] + [("control", "{}")]
    events = events_frame(spark, rows).withColumn("symbol", F.lit("tBTC:F0"))
    for _ in range(2):
        paths = write_capture_files(events.repartition(5), root)
        assert [p.removeprefix(root) for p in paths] == [
            f"/deribit/tbtc_f0/{c}/tbtc_f0_{c}_26-06-29.jsonl.gz" for c in ("control", "trades")
        ]
    files = raw.list_raw_files(spark, root, [DAY], ["trades", "control"], symbol="tBTC:F0")
    read = raw.read_raw_events(spark, files).where("channel = 'trades'").orderBy("line_no").collect()
    assert [json.loads(r["payload_text"])["n"] for r in read] == list(range(50))
    assert listing.capture_files(spark, root).count() == 2
    (tmp_path / "archive/deribit/tbtc_f0/trades/tbtc_f0_trades_26-06-29.jsonl").write_text("{}\n")
    with pytest.raises(ValueError, match="several forms"):
        raw.list_raw_files(spark, root, [DAY], ["trades"], symbol="tBTC:F0")
