"""Registered queries: each runs library operators over whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeloom import schemas
from tapeloom.functions import cursor, json_values, routing, text
from tapeloom.operators import facts, inspection, instruments, quality, ranking, trades
from tapeloom.operators.enrichment import attach_terms, in_schema_order
from tapeloom.plans.capture import capture, route_messages
from tapeloom.plans.history_load import load_history, page_trades
from tapeloom.plans.normalize_day import normalize_days
from tapeloom.registry import analogues
from tapeloom.registry.analogues import events_table, table
from tapeloom.session import materialize, scratch_dir
from tapeloom.sinks import capture_files, compaction, datasets, events as event_sink, history
from tapeloom.sources import feeds, listing, raw_capture, trade_pages
from tapeloom.streaming import jobs, sources as stream_sources

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

RANGE_START = "2024-01-10T00:00:00Z"
RANGE_END = "2024-01-20T12:30:00+02:00"
# Trades up to here are loaded by a batch before a stream takes over.
HALF_WAY = 1_705_276_800_000


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


def _replayed(events: DataFrame) -> DataFrame:
    """Received frames with their instant of receipt as `ts`."""
    return analogues.received_messages(events)


def _page_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique trades of all pages, with one symbol per event type."""
    rows = trade_pages.page_rows(analogues.trade_pages(spark, sf_dir))
    return trades.unique_trades(trades.derive_trades(trade_pages.good_rows(rows)))


def _one_symbol_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analogues.trade_pages(spark, sf_dir).drop("symbol")


def _terms(spark: SparkSession, sf_dir: str, keep=("date",)) -> DataFrame:
    listed = instruments.listed_instruments(analogues.control_events(spark, sf_dir), keep=keep)
    created = instruments.created_instruments(analogues.creation_events(spark, sf_dir), keep=keep)
    return instruments.latest_instruments(instruments.all_instruments(listed, created), keep=keep)


def _stored_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms stored before facts are joined, so their size is known and they are computed once."""
    return materialize(spark, _terms(spark, sf_dir, keep=()), "terms")


# Captures --------------------------------------------------------------------------------------


@registered
def envelope_build_parse(spark, sf_dir):
    frames = events_table(spark, sf_dir).select(
        "ts",
        F.lit("bitfinex").alias("exchange"),
        F.concat(F.lit("t"), F.col("user_id")).alias("symbol"),
        F.col("event_type").alias("channel"),
        F.concat(F.lit("conn-"), F.col("event_id")).alias("connection_id"),
        F.expr("if(event_type = 'error', NULL, props)").alias("text"),
        F.expr("if(event_type = 'error', cast(props AS binary), NULL)").alias("binary"),
    )
    built = raw_capture.build_envelopes(frames, F.col("ts"))
    lines = raw_capture.envelope_lines(built)
    with_blanks = lines.select(F.explode(F.array("value", F.lit(""), F.lit("  "))).alias("value"))
    parsed = raw_capture.parse_envelopes(raw_capture.without_blank_lines(with_blanks))
    return raw_capture.text_events(parsed).drop("payload_base64")


@registered
def binary_envelope_base64(spark, sf_dir):
    frames = table(spark, sf_dir, "documents").select(
        F.lit("hibachi").alias("exchange"),
        F.col("source").alias("symbol"),
        F.col("lang").alias("channel"),
        F.col("doc_id").cast("string").alias("connection_id"),
        F.encode("text", "UTF-8").alias("binary"),
    )
    built = raw_capture.build_envelopes(frames)
    lines = raw_capture.envelope_lines(built)
    parsed = raw_capture.parse_envelopes(lines)
    return parsed.select("symbol", "channel", "connection_id", "payload_text", "payload_base64")


@registered
def route_channels(spark, sf_dir):
    messages = _replayed(events_table(spark, sf_dir))
    return raw_capture.count_by_feed(route_messages(messages, F.col("ts")))


@registered
def captured_channel_counts(spark, sf_dir):
    root = scratch_dir(spark, "captured")
    capture(_replayed(events_table(spark, sf_dir)), root, F.col("ts"), gather=True)
    stored = raw_capture.read_landed_events(spark, root)
    return (
        event_sink.with_receipt_day(stored)
        .groupBy("exchange", "channel", F.col("date").cast("string").alias("day"))
        .agg(F.count(F.lit(1)).alias("messages"), F.min("received_mts").alias("first_mts"))
    )


@registered
def text_events_per_channel(spark, sf_dir):
    """Landed events that have a text, per channel; binary frames are left out."""
    root = scratch_dir(spark, "texts")
    frames = _replayed(events_table(spark, sf_dir))
    is_error = F.col("event_id") % 5 == 0
    frames = frames.withColumn("binary", F.when(is_error, F.encode("text", "UTF-8"))).withColumn(
        "text", F.when(~is_error, F.col("text"))
    )
    capture(frames, root, F.col("ts"), gather=True)
    return raw_capture.count_by_channel(raw_capture.read_landed_events(spark, root))


@registered
def first_messages_per_feed(spark, sf_dir):
    messages = _replayed(events_table(spark, sf_dir))
    feed = ["exchange", "symbol", "channel"]
    kept = ranking.first_rows_per_group(messages, feed, ["ts", "event_id"], 100)
    return kept.select(*feed, "event_id", "text")


@registered
def numbered_messages_per_feed(spark, sf_dir):
    messages = _replayed(events_table(spark, sf_dir)).drop("ts", "text")
    feed = ["exchange", "symbol", "channel"]
    return ranking.row_numbers(messages, feed, ["event_id"]).drop("connection_id")


@registered
def connection_lifecycle(spark, sf_dir):
    return jobs.connection_events(route_messages(_replayed(events_table(spark, sf_dir)), F.col("ts")))


@registered
def feed_coverage(spark, sf_dir):
    seen = _replayed(events_table(spark, sf_dir))
    catalogue = feeds.feed_catalogue(spark, [*schemas.VENUES, "bitfinex"]).drop("topics")
    return feeds.feed_coverage(catalogue, feeds.select_venues(seen, schemas.DEFAULT_VENUES))


# Trade history ---------------------------------------------------------------------------------


@registered
def exact_decimals(spark, sf_dir):
    """Numbers with up to 31 integer and 28 fractional digits, signs, zeros that mean nothing, and exponents."""
    digits = "lpad(l_orderkey, 12, '7')"
    forms = {
        0: f"concat('-', {digits}, l_partkey, '.', {digits}, {digits}, l_linenumber)",
        1: f"concat('+00', {digits}, {digits}, '7654321.5000')",
        2: f"concat('0.', repeat('0', 20), {digits})",
        3: f"concat('-', {digits}, '.25e-3')",
        4: f"concat({digits}, 'E20')",
        5: f"concat(' ', {digits})",
    }
    cases = " ".join(f"WHEN {n} THEN {form}" for n, form in forms.items())
    lines = table(spark, sf_dir, "lineitem").withColumn("number", F.expr(f"CASE l_linenumber % 7 {cases} ELSE '' END"))
    exact = text.parse_decimal(F.col("number"))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        exact.alias("exact"),
        text.absolute_decimal(exact).alias("size"),
        F.when(exact.isNotNull(), text.trade_side(exact)).alias("side"),
    )


@registered
def trade_rows_from_pages(spark, sf_dir):
    rows = trade_pages.page_rows(analogues.trade_pages(spark, sf_dir))
    derived = trades.derive_trades(trade_pages.good_rows(rows))
    return trades.stored_form(trades.unique_trades(derived))


@registered
def trades_time_range(spark, sf_dir):
    bounds = spark.range(1).select(
        text.parse_mts(F.lit(RANGE_START)).alias("first"), text.parse_mts(F.lit(RANGE_END)).alias("last")
    ).first()
    kept = trades.in_time_range(page_trades(_one_symbol_pages(spark, sf_dir), "tBTCUSD"), *bounds)
    return trades.unique_trades(kept).select("id", "mts", "side")


@registered
def parsed_instants(spark, sf_dir):
    given = F.expr(
        "CASE event_type WHEN 'view' THEN cast(mts AS string)"
        " WHEN 'click' THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
        " WHEN 'purchase' THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\")"
        " ELSE date_format(ts + INTERVAL '2' HOUR, \"yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'\") END"
    )
    day = F.date_format("ts", "yyyy-MM-dd")
    return events_table(spark, sf_dir).select(
        "event_id",
        text.parse_mts(given).alias("mts"),
        text.rfc3339_millis(text.mts_to_timestamp(text.parse_mts(given))).alias("instant"),
        text.rfc3339_seconds(F.col("ts")).alias("instant_seconds"),
        text.parse_date(day).cast("string").alias("day"),
    )


@registered
def first_n_trades(spark, sf_dir):
    page = page_trades(_one_symbol_pages(spark, sf_dir), "tBTCUSD")
    first = trades.sorted_trades(trades.first_trades(trades.unique_trades(page), 500))
    return trades.stored_form(first).select("id", "mts", "amount")


@registered
def first_n_trades_by_rank(spark, sf_dir):
    page = page_trades(_one_symbol_pages(spark, sf_dir), "tBTCUSD")
    first = trades.first_trades(trades.unique_trades(page), 5_000, top_k_rows=1_000)
    return trades.stored_form(first).select("id", "mts", "amount")


@registered
def first_n_trades_bounded(spark, sf_dir):
    """A limit that sketches of the trade times bound before anything is sorted."""
    page = materialize(spark, trades.unique_trades(page_trades(_one_symbol_pages(spark, sf_dir), "tBTCUSD")), "unique")
    return trades.stored_form(trades.first_trades(page, 2_000)).select("id", "mts", "amount")


@registered
def recent_page(spark, sf_dir):
    page = trades.unique_trades(page_trades(_one_symbol_pages(spark, sf_dir), "tBTCUSD"))
    return trades.stored_form(trades.recent_page(page, 1_000, max_trades=300)).select("id", "mts", "price")


@registered
def daily_trade_counts(spark, sf_dir):
    return trades.daily_counts(_page_trades(spark, sf_dir)).withColumn("date", F.col("date").cast("string"))


@registered
def last_trade_per_completed_day(spark, sf_dir):
    last = trades.last_trades_of_completed_days(_page_trades(spark, sf_dir))
    return last.withColumn("date", F.col("date").cast("string"))


@registered
def resume_filter(spark, sf_dir):
    history_trades = materialize(spark, _page_trades(spark, sf_dir).select("symbol", "id", "mts"), "trades")
    done = trades.last_trades_of_completed_days(history_trades).groupBy("symbol").agg(
        F.max("last_trade_mts").alias("last_mts"), F.count(F.lit(1)).alias("days")
    )
    requested = F.when(F.col("symbol") == "tview", F.lit(1_706_600_000_000))
    points = done.select(
        "symbol",
        cursor.resolve_start(requested, F.col("last_mts") + 1).alias("start_mts"),
        cursor.next_cursor(F.col("last_mts"), F.lit(0)).alias("cursor"),
        cursor.limit_remaining(F.lit(20), F.col("days")).alias("remaining"),
    )
    return history_trades.join(points, "symbol").where(F.col("mts") >= F.col("start_mts"))


@registered
def page_high_water_mark(spark, sf_dir):
    return trades.max_mts(_page_trades(spark, sf_dir))


@registered
def daily_parquet_roundtrip(spark, sf_dir):
    root = scratch_dir(spark, "roundtrip")
    page = page_trades(_one_symbol_pages(spark, sf_dir), "tBTCUSD")
    history.write_history(history.to_stored(trades.unique_trades(page)), root, "tBTCUSD")
    stored = history.read_history(spark, root, "tBTCUSD")
    file_name = text.daily_file_name(text.symbol_partition_name(F.col("symbol")), F.col("date"))
    return stored.withColumn("file_name", file_name).drop("date")


@registered
def compacted_history(spark, sf_dir):
    """Loads that add to the same days, compacted between and after, one day range loaded anew in the snapshot."""
    root, symbol = scratch_dir(spark, "compacted"), "tBTCUSD"
    stored = history.to_stored(trades.unique_trades(page_trades(_one_symbol_pages(spark, sf_dir), symbol)))
    stored = materialize(spark, stored, "compacted-trades")
    for part in range(4):
        history.append_new_trades(spark, stored.where(F.pmod("id", F.lit(4)) == part), root, symbol)
        if part == 2:
            compaction.compact_history(spark, root, symbol, least_files=2)
    history.write_history(stored.where("date < DATE '2024-01-12'"), root, symbol)
    compaction.compact_history(spark, root, symbol, least_files=2)
    compaction.remove_replaced(spark, root, symbol, older_than_ms=0)
    return history.read_history(spark, root, symbol).drop("date")


@registered
def stored_day_extents(spark, sf_dir):
    """Trades and their first and last instant per day: of appended files, and of the compacted ones beside them."""
    root, symbol = scratch_dir(spark, "extents"), "tBTCUSD"
    stored = history.to_stored(trades.unique_trades(page_trades(_one_symbol_pages(spark, sf_dir), symbol)))
    stored = materialize(spark, stored, "extent-trades")
    history.append_new_trades(spark, stored.where("id % 3 = 0"), root, symbol)
    history.append_new_trades(spark, stored.where("id % 3 = 1"), root, symbol)
    compaction.compact_history(spark, root, symbol, least_files=2)
    compaction.remove_replaced(spark, root, symbol, older_than_ms=0)
    history.append_new_trades(spark, stored, root, symbol)
    return history.stored_extents(spark, root, symbol)


@registered
def resumed_history(spark, sf_dir):
    root = scratch_dir(spark, "resumed")
    pages = _one_symbol_pages(spark, sf_dir)
    load_history(spark, pages, root, start=1_704_000_000_000, end=1_705_000_000_000)
    load_history(spark, pages, root)
    return history.read_history(spark, root, schemas.HISTORY_DEFAULT_SYMBOL).select("id", "mts", "side", "price")


@registered
def quarantine_page_rows(spark, sf_dir):
    pages = analogues.trade_pages(spark, sf_dir, analogues.BAD_PAGE)
    problem = F.coalesce(F.col("problem"), F.lit("good"))
    return trade_pages.page_rows(pages).groupBy("symbol", "row_index", problem.alias("problem")).agg(
        F.count(F.lit(1)).alias("rows")
    )


# Contract terms and facts ----------------------------------------------------------------------


@registered
def instruments_last_write_wins(spark, sf_dir):
    latest = _terms(spark, sf_dir, keep=())
    return in_schema_order(instruments.sorted_instruments(latest), schemas.INSTRUMENTS)


@registered
def discovery_filter(spark, sf_dir):
    return instruments.discovered_instruments(analogues.control_events(spark, sf_dir), keep=["line_no"])


@registered
def creation_filter(spark, sf_dir):
    return instruments.newly_created_instruments(analogues.creation_events(spark, sf_dir), keep=["line_no"])


@registered
def heartbeat_filter(spark, sf_dir):
    frames = events_table(spark, sf_dir).select("event_id", F.expr(analogues.FRAME_TEXT).alias("payload_text"))
    messages = json_values.parse_messages(frames, on_bad="keep")
    return messages.where(json_values.heartbeat_type() == "test_request").select("event_id")


@registered
def new_instruments_anti(spark, sf_dir):
    created = instruments.newly_created_instruments(analogues.creation_events(spark, sf_dir))
    known = instruments.discovered_instruments(analogues.control_events(spark, sf_dir))
    return instruments.unknown_instruments(created, known)


@registered
def new_instrument_count(spark, sf_dir):
    return new_instruments_anti(spark, sf_dir).agg(F.count(F.lit(1)).alias("instruments"))


@registered
def explode_trade_messages(spark, sf_dir):
    return facts.trade_rows(analogues.trade_events(spark, sf_dir), keep=["line_no"])


@registered
def trades_enriched(spark, sf_dir):
    rows = facts.trade_rows(analogues.trade_events(spark, sf_dir))
    return in_schema_order(attach_terms(rows, _stored_terms(spark, sf_dir)), schemas.DERIVATIVES_TRADES)


@registered
def trades_enriched_salted(spark, sf_dir):
    rows = facts.trade_rows(analogues.trade_events(spark, sf_dir), keep=["line_no"])
    rows = rows.select("line_no", "received_mts", "instrument_name", "price")
    joined = attach_terms(rows, _stored_terms(spark, sf_dir), strategy="salted", salt_by=["line_no", "received_mts"])
    return joined.select("line_no", "instrument_name", "price", "kind", "strike", "option_type")


@registered
def ticker_enriched(spark, sf_dir):
    rows = facts.ticker_rows(analogues.ticker_events(spark, sf_dir))
    return in_schema_order(attach_terms(rows, _stored_terms(spark, sf_dir)), schemas.INCREMENTAL_TICKER)


@registered
def normalize_counts(spark, sf_dir):
    """Messages landed as events, normalized by the day plan, and counted as stored."""
    landed, root = scratch_dir(spark, "landed-days"), scratch_dir(spark, "normalized")
    event_sink.append_events(analogues.capture_events(spark, sf_dir), landed, gather=True)
    normalize_days(spark, landed, root, analogues.DAYS, layout="landed")
    counted = None
    for dataset in schemas.DATASETS:
        one = datasets.read_dataset(spark, root, dataset, analogues.DAYS)
        known = F.count("kind") if dataset != "instruments" else F.count("strike")
        one = one.groupBy(F.lit(dataset).alias("dataset"), F.col("date").cast("string").alias("day")).agg(
            F.count(F.lit(1)).alias("rows"), known.alias("with_terms")
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted


@registered
def normalized_trades(spark, sf_dir):
    """Trade rows that the day plan stores, with the terms of their day."""
    landed, root = scratch_dir(spark, "landed-days"), scratch_dir(spark, "normalized")
    event_sink.append_events(analogues.capture_events(spark, sf_dir), landed, gather=True)
    normalize_days(spark, landed, root, analogues.DAYS, layout="landed")
    rows = datasets.read_dataset(spark, root, "trades", analogues.DAYS)
    return rows.select(F.col("date").cast("string").alias("day"), "instrument_name", "price", "trade_id", "kind", "strike", "option_type")


def _normalized_lines(spark: SparkSession, sf_dir: str):
    """The second day normalized from capture files of both days, which lack the ticker channel."""
    archive, root = scratch_dir(spark, "capture-files"), scratch_dir(spark, "normalized")
    events = analogues.capture_events(spark, sf_dir).where("channel <> 'incremental_ticker'")
    capture_files.write_capture_files(events, archive)
    return root, normalize_days(spark, archive, root, analogues.DAYS[1:], layout="lines")


@registered
def capture_files_normalized(spark, sf_dir):
    """Trade rows that the day plan stores from capture files."""
    root, _ = _normalized_lines(spark, sf_dir)
    rows = datasets.read_dataset(spark, root, "trades", analogues.DAYS[1:])
    return rows.select(F.col("date").cast("string").alias("day"), "instrument_name", "price", "trade_id", "kind", "strike", "option_type")


@registered
def capture_files_counts(spark, sf_dir):
    """Rows per dataset of a day whose ticker file is missing."""
    _, summary = _normalized_lines(spark, sf_dir)
    counts = {"instruments": summary.instruments, "incremental_ticker": summary.ticker_rows, "trades": summary.trade_rows}
    rows = [(dataset, str(day), n) for dataset, by_day in counts.items() for day, n in by_day.items()]
    return spark.createDataFrame(rows, "dataset string, day string, rows bigint")


@registered
def required_columns_hold(spark, sf_dir):
    rows = facts.trade_rows(analogues.trade_events(spark, sf_dir))
    stored = in_schema_order(attach_terms(rows, _stored_terms(spark, sf_dir)), schemas.DERIVATIVES_TRADES)
    return quality.null_counts(quality.check_required(stored, schemas.DERIVATIVES_TRADES), schemas.DERIVATIVES_TRADES)


@registered
def quarantine_payloads(spark, sf_dir):
    frames = events_table(spark, sf_dir).select(
        F.col("event_type").alias("kind"), F.expr(analogues.FRAME_TEXT).alias("payload_text")
    )
    control = analogues.control_events(spark, sf_dir).select(F.lit("control").alias("kind"), "payload_text")
    verdicts = quality.payload_verdicts(frames.unionByName(control))
    return verdicts.groupBy("kind", F.coalesce("problem", F.lit("good")).alias("problem")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@registered
def error_responses(spark, sf_dir):
    return quality.error_responses(analogues.control_events(spark, sf_dir)).select("line_no", "error")


# Scalars and names -----------------------------------------------------------------------------


@registered
def json_scalars(spark, sf_dir):
    value = F.expr(
        f"""CASE event_type
          WHEN 'view' THEN {analogues.number('value')}
          WHEN 'click' THEN {analogues.text("props_k")}
          WHEN 'purchase' THEN {analogues.number('value', 'e-9')}
          WHEN 'signup' THEN if(user_id % 2 = 0, 'true', {analogues.number('event_id')})
          ELSE if(user_id % 2 = 0, '{{"k":1}}', {analogues.number('value', 'e18')})
        END"""
    )
    events = events_table(spark, sf_dir).withColumn("props_k", F.get_json_object("props", "$.k"))
    documents = events.withColumn("v", value).select(
        "event_id",
        F.expr("""concat('{"id":', event_id - 100, ',"s":', v, ',"i":', v, ',"b":', v, ',"n":{"p":', v, '}}')""").alias("doc"),
    )
    parsed = json_values.parse_json_column(
        documents, "doc", "id bigint, s string, i bigint, b boolean, n struct<p: string>, t variant", "item"
    )
    return parsed.select(
        "event_id",
        json_values.response_id("item").alias("response_id"),
        json_values.scalar_text("item.s", "doc", "$.s").alias("as_text"),
        F.col("item.i").alias("as_integer"),
        F.col("item.b").alias("as_boolean"),
        json_values.scalar_text("item.n.p", "doc", "$.n.p").alias("nested_text"),
    )


@registered
def message_parts(spark, sf_dir):
    messages = json_values.parse_messages(analogues.ticker_events(spark, sf_dir))
    return messages.select(
        F.col("line_no"),
        json_values.message_channel().alias("message_channel"),
        json_values.message_data().isNotNull().alias("has_data"),
        F.col("message.jsonrpc").alias("version"),
    )


@registered
def symbol_partition_names(spark, sf_dir):
    urls = table(spark, sf_dir, "pages").select(F.col("url").alias("name"))
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    texts = table(spark, sf_dir, "documents").select(F.col("text").alias("name"))
    every = urls.unionByName(names).unionByName(texts)
    return every.select("name", text.symbol_partition_name(F.col("name")).alias("partition_name"))


@registered
def channel_names(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.concat(F.lit("P-"), F.col("p_partkey")).alias("instrument_name"), F.lower("p_type").alias("kind")
    )
    every = F.concat(routing.instrument_channels(F.col("instrument_name"), "agg2"), routing.lifecycle_channels(F.col("kind")))
    return part.select("instrument_name", F.explode(every).alias("channel"))


@registered
def subscribed_channels(spark, sf_dir):
    discovered = instruments.discovered_instruments(analogues.control_events(spark, sf_dir))
    return jobs.subscriptions(instruments.distinct_instruments(discovered))


@registered
def market_pick(spark, sf_dir):
    markets = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("position"),
        F.col("c_nationkey").alias("nation"),
        F.expr("if(c_acctbal > 9000, 'UBTC', c_mktsegment)").alias("base"),
        F.lit("USDC").alias("quote"),
        F.expr("CASE WHEN c_acctbal < 0 THEN 'btc/Usdc' WHEN c_acctbal < 5000 THEN concat(c_mktsegment, '-BTC/USDC') ELSE c_mktsegment END").alias("symbol"),
    )
    return routing.pick_market(markets, "UBTC", "USDC", "BTC/USDC", by=("nation",)).select("nation", "position", "match_rank")


@registered
def stored_file_names(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = text.utc_date(F.col("o_orderdate"))
    symbol = text.symbol_partition_name(F.col("o_orderpriority"))
    return orders.select(
        "o_orderkey",
        text.daily_file_name(symbol, day).alias("daily"),
        text.daily_stream_file_name(symbol, F.lit("trades"), day).alias("stream"),
        text.normalized_file_name(F.lit("trades"), day).alias("normalized"),
        text.decimal_text(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
    )


# Inspection ------------------------------------------------------------------------------------


@registered
def recent_files(spark, sf_dir):
    files = inspection.recent_files(listing.capture_files(spark, sf_dir, "*.parquet"))
    return files.select("exchange", "symbol", "channel", "size_mb", F.element_at(F.split("path", "/"), -1).alias("file"))


@registered
def newest_file_per_exchange(spark, sf_dir):
    root = scratch_dir(spark, "inspected")
    messages = _replayed(events_table(spark, sf_dir))
    capture(messages, root, F.col("ts"), gather=True)
    files = listing.capture_files(spark, root, "*.parquet")
    return inspection.newest_per_exchange(files).select("exchange", "symbol", "channel")


@registered
def file_heads(spark, sf_dir):
    root = scratch_dir(spark, "heads")
    envelopes = route_messages(_replayed(events_table(spark, sf_dir)), F.col("ts"))
    lines = raw_capture.envelope_lines(envelopes)
    lines.write.option("compression", "gzip").text(root)
    newest = inspection.newest_file(listing.capture_files(spark, root, "*.txt.gz")).first()
    head = listing.file_head(spark, newest["path"], 5)
    return inspection.expand_payload_text(head).select("exchange", "channel", F.col("payload").cast("string").alias("payload"))


@registered
def capture_file_listing(spark, sf_dir):
    """The newest capture files: places, names, and whether they have a size and a time."""
    root = scratch_dir(spark, "capture-files")
    capture_files.write_capture_files(analogues.capture_events(spark, sf_dir), root)
    files = inspection.recent_files(listing.capture_files(spark, root))
    return files.select(
        "exchange",
        "symbol",
        "channel",
        F.element_at(F.split("path", "/"), -1).alias("file"),
        (F.col("size_mb") > 0).alias("has_bytes"),
        (F.col("modified_at") > F.lit(dt.datetime(2020, 1, 1))).alias("has_time"),
    )


@registered
def capture_file_heads(spark, sf_dir):
    """The first three messages of each of the newest capture files."""
    root = scratch_dir(spark, "capture-files")
    capture_files.write_capture_files(analogues.capture_events(spark, sf_dir), root)
    heads = None
    for sample in inspection.recent_samples(spark, root, rows=3).values():
        head = sample.select("channel", "received_mts", F.col("payload").isNotNull().alias("has_payload"))
        heads = head if heads is None else heads.unionByName(head)
    return heads


@registered
def payload_expand(spark, sf_dir):
    props = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.lit("props").alias("origin"), F.col("props").alias("payload_text"))
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("text").alias("origin"), F.col("text").alias("payload_text"))
    missing = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.lit("none").alias("origin"), F.lit(None).cast("string").alias("payload_text"))
    expanded = inspection.expand_payload_text(props.unionByName(documents).unionByName(missing))
    kind = F.when(F.schema_of_variant("payload").startswith("OBJECT"), "object").when(F.schema_of_variant("payload") == "STRING", "text")
    return expanded.select(
        "id",
        "origin",
        kind.alias("kind"),
        F.try_variant_get("payload", "$.k", "bigint").alias("k"),
        F.when(kind == "text", F.col("payload").cast("string")).alias("raw_text"),
    )


@registered
def exchange_filter(spark, sf_dir):
    seen = _replayed(events_table(spark, sf_dir)).withColumn("symbol", F.lower("symbol"))
    return inspection.files_of(seen, "hyperliquid", "spot_btc").select("event_id", "channel", "text")


# Streams ---------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return analogues.with_millis(analogues.spread(source, sf_dir, "events"))


def _run(query) -> None:
    query.awaitTermination()


@registered
def stream_route_land(spark, sf_dir):
    root, checkpoint = scratch_dir(spark, "landed"), scratch_dir(spark, "landed-state")
    messages = analogues.received_messages(_event_stream(spark, sf_dir))
    _run(jobs.route_and_land(messages, root, checkpoint, F.col("ts"), available_now=True))
    return raw_capture.count_by_feed(raw_capture.read_landed_events(spark, root))


@registered
def stream_lines_land(spark, sf_dir):
    """Messages as lines of a landing directory, streamed and landed."""
    landing, root, state = (scratch_dir(spark, name) for name in ("lines", "landed", "landed-state"))
    messages = _replayed(events_table(spark, sf_dir))
    line = F.to_json(F.struct("exchange", "symbol", "channel", "connection_id", "text"))
    messages.select(line.alias("value")).write.option("compression", "gzip").text(landing)
    streamed = stream_sources.message_stream(stream_sources.line_stream(spark, landing))
    _run(jobs.route_and_land(streamed, root, state, available_now=True))
    return raw_capture.count_by_feed(raw_capture.read_landed_events(spark, root))


@registered
def landed_by_channel(spark, sf_dir):
    """Envelopes below one root per channel, and those of the other channels below a last one."""
    roots = {channel: scratch_dir(spark, f"landed-{channel}") for channel in ("trades", "control", "incremental_ticker")}
    rest = scratch_dir(spark, "landed-rest")
    envelopes = materialize(spark, route_messages(_replayed(events_table(spark, sf_dir)), F.col("ts")), "envelopes")
    event_sink.append_by_channel(envelopes, roots, rest)
    counted = None
    for place, root in {**roots, "rest": rest}.items():
        one = raw_capture.count_by_feed(raw_capture.read_landed_events(spark, root)).withColumn("place", F.lit(place))
        counted = one if counted is None else counted.unionByName(one)
    return counted


@registered
def landed_batch_stream_batch(spark, sf_dir):
    """The same messages landed three times below one root: by a batch, a stream, and a batch again."""
    root, checkpoint = scratch_dir(spark, "landed"), scratch_dir(spark, "landed-state")
    messages = _replayed(events_table(spark, sf_dir))
    capture(messages, root, F.col("ts"), gather=True)
    streamed = analogues.received_messages(_event_stream(spark, sf_dir))
    for _ in range(2):  # the second run finds nothing new
        _run(jobs.route_and_land(streamed, root, checkpoint, F.col("ts"), available_now=True))
    capture(messages, root, F.col("ts"), gather=True)
    return raw_capture.count_by_feed(raw_capture.read_landed_events(spark, root))


@registered
def history_batch_then_stream(spark, sf_dir):
    """Trades of all pages, loaded by a batch and then met again by a stream of the same root."""
    root, checkpoint = scratch_dir(spark, "trades"), scratch_dir(spark, "trades-state")
    load_history(spark, _one_symbol_pages(spark, sf_dir), root, "tBTCUSD", start=0, end=HALF_WAY)
    pages = _event_stream(spark, sf_dir).select(F.expr(analogues.PAGE).alias("page"))
    _run(jobs.history_stream(pages, root, "tBTCUSD", checkpoint, available_now=True))
    return history.read_history(spark, root, "tBTCUSD").drop("date")


@registered
def stream_terms_between_batches(spark, sf_dir):
    """Ticker rows of two runs of one stream; the terms are stored only after the first."""
    terms, path, state = (scratch_dir(spark, name) for name in ("late-terms", "rows", "rows-state"))
    schema = schemas.INSTRUMENTS
    spark.createDataFrame([], schema).write.parquet(terms)
    landing = scratch_dir(spark, "late-events")
    events = analogues.ticker_events(spark, sf_dir)
    for day in analogues.DAYS:
        events.where(F.col("date") == F.lit(day)).write.mode("append").parquet(landing)
        source = spark.readStream.schema(events.schema).parquet(landing)
        read_terms = lambda session: session.read.schema(schema).parquet(terms)
        _run(jobs.normalize_stream(source, read_terms, "incremental_ticker", path, state, available_now=True))
        in_schema_order(_terms(spark, sf_dir, keep=()), schema).write.mode("overwrite").parquet(terms)
    rows = spark.read.schema(schemas.INCREMENTAL_TICKER).parquet(path)
    return rows.groupBy("instrument_name").agg(F.count(F.lit(1)).alias("rows"), F.count("kind").alias("with_terms"))


@registered
def stream_late_terms(spark, sf_dir):
    """Ticker rows of a stream that waited for terms stored after its first run, and of what never got any."""
    terms, path, state, pending = (scratch_dir(spark, name) for name in ("late-terms", "rows", "rows-state", "pending"))
    schema = schemas.INSTRUMENTS
    spark.createDataFrame([], schema).write.parquet(terms)
    landing = scratch_dir(spark, "late-events")
    events = analogues.ticker_events(spark, sf_dir)
    read_terms = lambda session: session.read.schema(schema).parquet(terms)
    for day in analogues.DAYS:
        events.where(F.col("date") == F.lit(day)).write.mode("append").parquet(landing)
        source = spark.readStream.schema(events.schema).parquet(landing)
        _run(jobs.normalize_stream(source, read_terms, "incremental_ticker", path, state, available_now=True, pending=pending))
        in_schema_order(_terms(spark, sf_dir, keep=()), schema).write.mode("overwrite").parquet(terms)
    jobs.finish_pending(events, read_terms(spark), "incremental_ticker", path, pending)
    return in_schema_order(spark.read.schema(schemas.INCREMENTAL_TICKER).parquet(path), schemas.INCREMENTAL_TICKER)


@registered
def stream_first_seen(spark, sf_dir):
    path, checkpoint = scratch_dir(spark, "seen"), scratch_dir(spark, "seen-state")
    events = analogues.creation_events(spark, sf_dir, _event_stream(spark, sf_dir))
    seen = jobs.subscriptions(jobs.first_seen_instruments(events))
    writer = seen.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    _run(writer.trigger(availableNow=True).start(path))
    return spark.read.schema("instrument_name string, channel string").parquet(path)


@registered
def stream_normalize(spark, sf_dir):
    path, checkpoint = scratch_dir(spark, "rows"), scratch_dir(spark, "rows-state")
    events = analogues.ticker_events(spark, sf_dir, _event_stream(spark, sf_dir))
    terms = _stored_terms(spark, sf_dir)
    _run(jobs.normalize_stream(events, terms, "incremental_ticker", path, checkpoint, available_now=True))
    stored = spark.read.schema(schemas.INCREMENTAL_TICKER).parquet(path)
    return in_schema_order(stored, schemas.INCREMENTAL_TICKER)


@registered
def stream_history(spark, sf_dir):
    root, checkpoint = scratch_dir(spark, "trades"), scratch_dir(spark, "trades-state")
    pages = _event_stream(spark, sf_dir).select(F.expr(analogues.PAGE).alias("page"))
    _run(jobs.history_stream(pages, root, "tBTCUSD", checkpoint, available_now=True))
    return history.read_history(spark, root, "tBTCUSD").drop("date")
