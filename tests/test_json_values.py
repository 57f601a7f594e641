import pytest
from conftest import collect, events_frame

from tapeloom.functions import json_values as j
from pyspark.sql import functions as F

NUMBERS = {
    "60000.0": "60000.0", "0.0434492": "0.0434492", "1.10": "1.1", "-0.0": "-0.0", "0": "0", "7": "7",
    "12345678.9": "12345678.9", "1e-7": "1e-7", "1.50e-7": "1.5e-7", "0.00001": "0.00001",
    "0.00012155": "0.00012155", "-0.00012155": "-0.00012155", "0.000009": "9e-6", "1e15": "1000000000000000.0",
    "1.5e15": "1500000000000000.0", "9007199254740993.5": "9007199254740994.0", "1e16": "1e16",
    "12345678901234567.5": "1.2345678901234568e16", "1e20": "1e20", "-2.5e300": "-2.5e300",
    "9223372036854775807": "9223372036854775807", "18446744073709551615": "18446744073709551615",
    "18446744073709551616": "1.8446744073709552e19", "-9223372036854775808": "-9223372036854775808",
    "-9223372036854775809": "-9.223372036854776e18",
    "123456789012345678901234567890123456789012": "1.2345678901234568e41",
}
OTHERS = {
    "null": None, "true": "true", "false": "false", '"s"': "s", '""': "", '"1.0E-7"': "1.0E-7",
    '"18446744073709551616"': "18446744073709551616", '"{x"': "{x", '"[1]"': "[1]", "[1]": None,
    '{"a":"b"}': None, '"[\\u0041]"': "[A]", '"[a\\nb]"': "[a\nb]", '"{a\\/b}"': "{a/b}", '"{\\"a\\":\\"b\\"}"': '{"a":"b"}', '"60000.0"': "60000.0",
}


def scalar_texts(spark, literals):
    docs = [(i, '{"v":%s}' % literal) for i, literal in enumerate(literals)]
    parsed = j.parse_json_column(spark.createDataFrame(docs, "i int, doc string"), "doc", "v string, w string", "p")
    rows = parsed.select("i", j.scalar_text("p.v", "doc", "$.x.v", "$.v").alias("text")).collect()
    return {literals[r["i"]]: r["text"] for r in rows}


def test_scalar_text(spark):
    expected = {**NUMBERS, **OTHERS}
    got = scalar_texts(spark, list(expected))
    assert got == expected


@pytest.mark.parametrize(
    ("payload", "good"),
    [
        ('{"jsonrpc":"2.0","params":{"data":[{"price":1}]}}', True),
        ('{"jsonrpc":"2.0","params":{"data":[{"price":nope}]}}', False),
        ('{"jsonrpc":"2.0"} junk', False),
        ('{"jsonrpc":"2.0"} {"b":1}', False),
        ('{"jsonrpc":"2.0"},{"b":1}', False),
        ('{"jsonrpc":"2.0","params":', False),
        ('{"id":"text","params":7}', True),
        (' {"a":1} ', True),
        ("5", True),
        ("null", True),
        ("[1,2]", True),
        ("", False),
        ("],[", False),
        ('{"a":1}] junk', False),
        ('{"a":1},{}] junk', False),
        ("1],[2", False),
    ],
)
def test_a_payload_is_judged_whole(spark, payload, good):
    events = events_frame(spark, [("c", payload)])
    checked = j.parse_messages(events, on_bad="keep").select(j.payload_is_json().alias("good")).collect()
    assert [r["good"] for r in checked] == [good]
    if not good:
        with pytest.raises(Exception, match="invalid JSON"):
            j.parse_messages(events).collect()


def test_integers_and_booleans_keep_their_json_type(spark):
    docs = ['{"i":%s,"b":%s,"s":1}' % pair for pair in
            [("5", "true"), ('"5"', '"true"'), ("5.0", "1"), ("true", "null"), ("18446744073709551615", "false")]]
    df = spark.createDataFrame([(k, d) for k, d in enumerate(docs)], "k int, doc string")
    parsed = j.parse_json_column(df, "doc", "i bigint, b boolean, s string", "p").orderBy("k").select("p.*")
    assert [tuple(r) for r in parsed.collect()] == [
        (5, True, "1"), (None, None, "1"), (None, None, "1"), (None, None, "1"), (None, False, "1")]


@pytest.mark.parametrize(
    "payload, expected",
    [
        ('{"params":{"data":"a"},"data":"b"}', "a"),
        ('{"params":{},"data":"b"}', "b"),
        ('{"params":5,"data":"b"}', "b"),
        ('{"data":"b"}', "b"),
        ('{"params":{"data":null},"data":"b"}', None),
        ('{"jsonrpc":"2.0"}', None),
    ],
)
def test_message_data(spark, payload, expected):
    events = events_frame(spark, [("control", payload)])
    [row] = j.parse_messages(events).select(j.message_data().alias("d")).collect()
    assert row["d"] == expected


def test_message_channel_must_be_a_string(spark):
    payloads = ['{"params":{"channel":"trades.X"}}', '{"params":{"channel":5}}', '{"params":{"channel":null}}', "{}"]
    events = events_frame(spark, [("c", p) for p in payloads])
    rows = j.parse_messages(events).orderBy("line_no").select(j.message_channel().alias("c")).collect()
    assert [r["c"] for r in rows] == ["trades.X", None, None, None]


def test_heartbeat_and_response_id(spark):
    payloads = [
        '{"method":"heartbeat","params":{"type":"test_request"}}',
        '{"method":"heartbeat","params":{"type":"heartbeat"}}',
        '{"method":"subscription","params":{"type":"test_request"}}',
        '{"id":2}', '{"id":-2}', '{"id":"2"}', '{"id":2.0}',
    ]
    events = events_frame(spark, [("c", p) for p in payloads])
    rows = collect(
        j.parse_messages(events).orderBy("line_no").select(j.heartbeat_type().alias("h"), j.response_id().alias("i"))
    )
    assert [r["h"] for r in rows] == ["test_request", "heartbeat", None, None, None, None, None]
    assert [r["i"] for r in rows] == [None, None, None, 2, None, None, None]


def test_parsed_fields_are_filtered_without_a_second_parse(spark, capsys):
    events = events_frame(spark, [("c", "{}")])
    j.parse_messages(events).where(j.message_channel() == "x").explain()
    assert capsys.readouterr().out.count("from_json(") == 1
