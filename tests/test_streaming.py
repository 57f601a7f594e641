import json
import shutil

from conftest import CONTROL, NAME, TRADES, compress, collect, envelope
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.operators.instruments import latest_instruments, listed_instruments
from tapeloom.plans.capture import capture
from tapeloom.plans.history_load import load_history
from tapeloom.sinks.events import append_event_stream
from tapeloom.sinks.history import read_history
from tapeloom.sources.raw_capture import parse_envelopes, read_landed_events
from tapeloom.streaming import jobs, pending, sources
from conftest import events_frame


def land(directory, name, lines):
    directory.mkdir(exist_ok=True)
    text = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    if name.endswith(".zst"):
        (directory / name).write_bytes(compress(text))
    else:
        (directory / name).write_text("\n".join(text) + "\n")


def message(text, channel="instrument_lifecycle", exchange="deribit"):
    return {"exchange": exchange, "symbol": "BTC", "channel": channel, "connection_id": "c", "text": text}


def test_route_and_land_resumes_from_its_checkpoint(spark, tmp_path):
    landing, root, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = sources.message_stream(sources.line_stream(spark, str(landing)))
        jobs.route_and_land(stream, root, state, available_now=True).awaitTermination()
        return {r["channel"]: r["n"] for r in read_landed_events(spark, root).groupBy("channel").agg(F.count("*").alias("n")).collect()}

    land(landing, "a.jsonl", [message(TRADES), message("hello"), "", message(CONTROL)])
    assert run() == {"trades": 1, "control": 2}
    land(landing, "b.jsonl.zst", [message(TRADES), message('{"event":"connected"}', exchange="hyperliquid")])
    assert run() == {"trades": 2, "control": 3}
    assert run() == {"trades": 2, "control": 3}
    events = collect(jobs.connection_events(read_landed_events(spark, root)))
    assert [(r["event"], r["times"]) for r in events] == [("connected", 1)]


def test_first_seen_survives_restarts(spark, tmp_path):
    landing, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    creation = '{"params":{"channel":"instrument.creation.option.BTC","data":{"instrument_name":"%s"}}}'

    def run():
        events = parse_envelopes(sources.line_stream(spark, str(landing)))
        seen = jobs.first_seen_instruments(events)
        query = seen.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
        query.awaitTermination()
        return sorted(r[0] for r in spark.read.schema("instrument_name string").parquet(out).collect())

    listed = CONTROL.replace("quote_currency", "x")
    land(landing, "a.jsonl", [envelope("control", listed)] * 3 + [envelope("instrument_creation", creation % "N")] * 5)
    assert run() == sorted([NAME, "N"])
    land(landing, "b.jsonl", [envelope("instrument_creation", creation % n, mts=k) for k, n in enumerate([NAME, "N", "M", "M"])])
    assert run() == sorted([NAME, "N", "M"])
    names = spark.createDataFrame([("N",)], "instrument_name string")
    assert [r["channel"] for r in jobs.subscriptions(names).collect()] == ["incremental_ticker.N", "trades.N.100ms"]


def test_stream_is_joined_to_stored_terms(spark, tmp_path):
    landing, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    terms = latest_instruments(listed_instruments(events_frame(spark, [("control", CONTROL)])))
    land(landing, "a.jsonl.zst", [envelope("trades", TRADES), envelope("trades", TRADES.replace(NAME, "other"))])
    events = parse_envelopes(sources.line_stream(spark, str(landing)))
    jobs.normalize_stream(events, terms, "trades", out, state, available_now=True).awaitTermination()
    rows = {r["instrument_name"]: r for r in collect(spark.read.parquet(out))}
    assert rows[NAME]["kind"] == "option" and rows["other"]["kind"] is None
    assert str(rows[NAME]["date"]) == "2026-06-29"


def test_history_stream_takes_each_trade_once(spark, tmp_path):
    landing, root, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run(state=state):
        pages = sources.page_stream(spark, str(landing))
        jobs.history_stream(pages, root, "tX", state, available_now=True).awaitTermination()
        return sorted(r["id"] for r in read_history(spark, root, "tX").collect())

    land(landing, "a.json", ["[[1,1740852000000,1,1],[2,1740852000001,1,1]]"])
    assert run() == [1, 2]
    land(landing, "b.json", ["[[2,1740852000001,1,1],[3,1740938400000,1,1]]", "[]"])
    assert run() == [1, 2, 3]
    # A batch load of the same root, and a stream that reads every page again, change nothing and lose nothing.
    batch = spark.createDataFrame([("[[4,1740938400001,1,1],[3,1740938400000,1,1]]",)], "page string")
    load_history(spark, batch, root, "tX", start=1740938400000)
    assert run() == [1, 2, 3, 4]
    assert run(str(tmp_path / "other-state")) == [1, 2, 3, 4]


def test_batches_and_streams_share_a_root_and_a_repeated_batch_replaces_itself(spark, tmp_path):
    landing, root, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    batch = spark.createDataFrame([("deribit", "BTC", "x", "c", TRADES)], "exchange string, symbol string, channel string, connection_id string, text string")

    def stored():
        return read_landed_events(spark, root).count()

    capture(batch, root)
    land(landing, "a.jsonl", [message(TRADES), message("hello")])
    stream = sources.message_stream(sources.line_stream(spark, str(landing)))
    jobs.route_and_land(stream, root, state, available_now=True).awaitTermination()
    assert stored() == 3
    capture(batch, root)
    assert stored() == 4
    # The commit of the last micro-batch is lost: the batch runs again.
    for name in ("0", ".0.crc"):
        (tmp_path / "state" / "commits" / name).unlink()
    stream = sources.message_stream(sources.line_stream(spark, str(landing)))
    jobs.route_and_land(stream, root, state, available_now=True).awaitTermination()
    assert stored() == 4


def waiting_terms(spark, *names):
    rows = [(name, f"kind of {name}") for name in names]
    terms = spark.createDataFrame(rows, "instrument_name string, kind string")
    for name in schemas.TERM_COLUMNS:
        if name != "kind":
            terms = terms.withColumn(name, F.lit(None).cast("string"))
    return terms


def test_facts_wait_for_their_terms_and_none_is_lost_or_doubled(spark, tmp_path):
    root, schema = str(tmp_path / "pending"), "instrument_name string, received_mts bigint"

    def run(number, rows, terms, **options):
        got = pending.settle(spark.createDataFrame(rows, schema), terms, root, f"stream-a-b-{number}", **options).collect()
        return sorted((r.instrument_name, r.received_mts, r.kind) for r in got)

    none, some = waiting_terms(spark), waiting_terms(spark, "x")
    assert run(0, [("x", 1), ("y", 2), ("y", 2)], none) == []
    for _ in range(2):  # a repeated micro-batch gives the same again
        assert run(1, [("x", 3), ("z", 9)], some) == [("x", 1, "kind of x"), ("x", 3, "kind of x")]
    assert run(2, [], some) == []
    assert run(4, [("x", 10)], some, give_up_ms=5) == [("x", 10, "kind of x"), ("y", 2, None), ("y", 2, None)]
    # A stream with another checkpoint keeps rows of its own.
    other = pending.settle(spark.createDataFrame([("y", 5)], schema), none, root, "stream-c-0")
    assert other.count() == 0
    late = pending.release(spark, root, waiting_terms(spark, "z"), spark.createDataFrame([], schema).schema).collect()
    assert sorted((r.instrument_name, r.kind) for r in late) == [("y", None), ("z", "kind of z")]
    pending.forget(spark, root)
    assert pending.release(spark, root, none, spark.createDataFrame([], schema).schema).count() == 0


def test_a_lost_checkpoint_replaces_no_loads(spark, tmp_path):
    """Micro-batches of a new checkpoint at the same place count from 0 again, and their labels differ."""
    landing, root, checkpoint = (str(tmp_path / name) for name in ("in", "out", "state"))
    events_frame(spark, [("trades", "{}")]).write.parquet(landing)
    for _ in range(2):
        source = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
        append_event_stream(source, root, checkpoint, available_now=True).awaitTermination()
        shutil.rmtree(checkpoint)
    stored = spark.read.parquet(root)
    assert stored.count() == 2 and stored.select("load").distinct().count() == 2
