import datetime as dt

import pytest
from conftest import collect
from pyspark.sql import functions as F

from tapeloom.functions import cursor, routing, text
from tapeloom.sources.raw_capture import partition_name, raw_file_path


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_symbol_partition_name(spark):
    cases = {"SOLeur": "soleur", "a:B:c9": "a_b_c9", "X/y-Z": "x_y-z", "É\U0001f600x_": "__x_"}
    rows = [(k,) for k in cases]
    assert values(spark, text.symbol_partition_name(F.col("s")), rows, "s string") == list(cases.values())
    assert [partition_name(k) for k in cases] == list(cases.values())
    with pytest.raises(Exception, match="at least one character"):
        values(spark, text.symbol_partition_name(F.col("s")), [("",)], "s string")
    with pytest.raises(ValueError):
        partition_name("")


def test_decimal_text(spark):
    from decimal import Decimal

    cases = {"731.50": "731.5", "300": "300", "0.000": "0", "-0.00480": "-0.0048", "90.000": "90"}
    rows = [(Decimal(k),) for k in cases]
    assert values(spark, text.decimal_text(F.col("d")), rows, "d decimal(38,18)") == list(cases.values())


def test_parse_mts(spark):
    cases = {
        "2025-03-01T06:00:00Z": 1740808800000,
        "1740808800000": 1740808800000,
        "2025-03-01T08:00:00.25+02:00": 1740808800250,
        "2025-03-01T04:30:00-01:30": 1740808800000,
    }
    rows = [(k,) for k in cases]
    assert values(spark, text.parse_mts(F.col("s")), rows, "s string") == list(cases.values())
    for bad in ("-5", "2026-06-14", "2026-06-14T00:00:00", "x"):
        with pytest.raises(Exception, match="neither epoch milliseconds"):
            values(spark, text.parse_mts(F.col("s")), [(bad,)], "s string")


def test_parse_decimal_rounds_nothing(spark):
    cases = {
        "0.12345678901234567890123": "0.12345678901234567890123", "-0.00000000000000000001": "-0.00000000000000000001",
        "123456789012345678901234.50": "123456789012345678901234.5", "-0.0": "0", "+007": "7", ".5": "0.5", "5.": "5",
        "1.5e3": "1500", "1e-3": "0.001", "-12.25E-1": "-1.225", "1000e-2": "10", "0e9": "0", "2E20": "2" + "0" * 20,
        " 1 ": None, "": None, "1,5": None, "e5": None, "1e": None, "--1": None, "NaN": None, ".": None, "1e100": None,
    }
    got = values(spark, text.parse_decimal(F.col("s")), [(k,) for k in cases], "s string")
    assert got == list(cases.values())
    rows = [("-0.5",), ("0.5",), ("0",)]
    assert values(spark, text.trade_side(F.col("s")), rows, "s string") == ["sell", "buy", "buy"]
    assert values(spark, text.absolute_decimal(F.col("s")), rows, "s string") == ["0.5", "0.5", "0"]


def test_parse_date_and_integer(spark):
    assert values(spark, text.parse_date(F.col("s")), [("2026-06-29",)], "s string") == [dt.date(2026, 6, 29)]
    with pytest.raises(Exception):
        values(spark, text.parse_date(F.col("s")), [("29.06.2026",)], "s string")
    rows = [("5",), ("+5",), ("-5",), ("5.0",), (" 5",), ("9223372036854775808",), ("",), (None,)]
    assert values(spark, text.parse_integer(F.col("s")), rows, "s string") == [5, 5, -5] + [None] * 5


def test_instants_and_names(spark):
    df = spark.createDataFrame([(1740808801375, "soleur")], "mts bigint, s string")
    at = text.mts_to_timestamp(F.col("mts"))
    day = text.utc_date(at)
    [row] = collect(
        df.select(
            text.rfc3339_millis(at).alias("a"),
            text.rfc3339_seconds(at).alias("b"),
            day.alias("c"),
            text.daily_file_name(F.col("s"), day).alias("d"),
            text.daily_stream_file_name(F.col("s"), F.lit("book_l25"), day).alias("e"),
            text.normalized_file_name(F.lit("trades"), day).alias("f"),
        )
    )
    assert list(row.values()) == [
        "2025-03-01T06:00:01.375Z",
        "2025-03-01T06:00:01Z",
        dt.date(2025, 3, 1),
        "soleur_25-03-01.parquet",
        "soleur_book_l25_25-03-01.jsonl.zst",
        "btc_trades_25-03-01.parquet",
    ]
    assert raw_file_path("/r/", "trades", dt.date(2026, 6, 29), "deribit", "BTC") == (
        "/r/deribit/btc/trades/btc_trades_26-06-29.jsonl.zst"
    )


def test_base64_is_one_line(spark):
    [got] = values(spark, text.base64_text(F.col("b")), [(bytearray(range(256)),)], "b binary")
    import base64

    assert got == base64.b64encode(bytes(range(256))).decode()


def test_cursor(spark):
    rows = [(None, 5), (3, 5), (9, 5), (9, None), (None, None)]
    got = values(spark, cursor.resolve_start(F.col("a"), F.col("b")), rows, "a bigint, b bigint")
    assert got == [5, 5, 9, 9, None]
    rows = [(10, 3), (3, 10), (None, 4)]
    got = values(spark, cursor.limit_remaining(F.col("a"), F.col("b")), rows, "a bigint, b bigint")
    assert got == [7, 0, None]
    assert values(spark, cursor.next_cursor(F.col("a"), F.col("b")), [(4, 4)], "a bigint, b bigint") == [5]
    with pytest.raises(Exception, match="would not start behind"):
        values(spark, cursor.next_cursor(F.col("a"), F.col("b")), [(3, 4)], "a bigint, b bigint")


SUB = '{"jsonrpc":"2.0","method":"subscription","params":{"channel":"%s","data":{}}}'


def test_routing(spark):
    cases = {
        SUB % "instrument.creation.future.BTC": "instrument_creation",
        SUB % "instrument.state.option.BTC": "instrument_state",
        SUB % "incremental_ticker.SOL_USDC": "incremental_ticker",
        SUB % "trades.SOL_USDC.raw": "trades",
        '{"id":77,"result":[]}': "control",
        SUB % "book.BTC": "control",
        '{"params":{"channel":5}}': "control",
        "not json": "control",
    }
    got = values(spark, routing.derivatives_output_channel(F.col("p")), [(k,) for k in cases], "p string")
    assert got == list(cases.values())
    spot = {'{"channel":"trades","data":[]}': "trades", '{"channel":"l2Book"}': "book", '{"event":"connected"}': "control"}
    got = values(spark, routing.spot_output_channel(F.col("p")), [(k,) for k in spot], "p string")
    assert got == list(spot.values())
    rows = [("deribit", "feed", SUB % "trades.X"), ("hyperliquid", "feed", "{}"), ("bitfinex", "book_l25", "[]")]
    column = routing.output_channel(F.col("e"), F.col("c"), F.col("p"))
    assert values(spark, column, rows, "e string, c string, p string") == ["trades", "control", "book_l25"]


def test_channel_names(spark):
    kinds = spark.createDataFrame([("future",), ("option",)], "k string")
    got = [r[0] for r in kinds.select(F.explode(routing.lifecycle_channels(F.col("k")))).collect()]
    assert got == [
        "instrument.creation.future.BTC",
        "instrument.state.future.BTC",
        "instrument.creation.option.BTC",
        "instrument.state.option.BTC",
    ]
    [names] = values(spark, routing.instrument_channels(F.col("n")), [("SOL_USDC",)], "n string")
    assert names == ["incremental_ticker.SOL_USDC", "trades.SOL_USDC.100ms"]
    with pytest.raises(ValueError):
        routing.instrument_channels(F.col("n"), "1s")


def test_market_pick(spark):
    def pick(*rows):
        df = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], "position int, base string, quote string, symbol string")
        return [r["position"] for r in routing.pick_market(df, "UBTC", "USDC", "BTC/USDC").collect()]

    assert pick(("A", "B", "xBTC/USDC"), ("A", "B", "btc/usdc"), ("UBTC", "USDC", "z"), ("UBTC", "USDC", "y")) == [2]
    assert pick(("A", "B", "xBTC/USDC"), ("A", "B", "btc/usdc")) == [1]
    assert pick(("A", "B", "q"), ("A", "B", "xBTC/USDC"), ("A", "B", "yBTC/USDC")) == [1]
    assert pick(("A", "B", "xbtc/usdc")) == []
