"""Streaming jobs: route and land, first-seen instruments, incremental normalize and history."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeloom import schemas
from tapeloom.functions.routing import instrument_channels
from tapeloom.operators.enrichment import attach_terms, in_schema_order
from tapeloom.operators.facts import ticker_rows, trade_rows
from tapeloom.operators.instruments import discovered_instruments, newly_created_instruments
from tapeloom.plans.capture import route_messages
from tapeloom.plans.history_load import page_trades
from tapeloom.operators.trades import unique_trades
from tapeloom.sinks.events import append_event_stream, each_batch, replace_parts, with_receipt_day
from tapeloom.sinks.history import append_new_trades, to_stored
from tapeloom.streaming.pending import forget, release, settle

# Partial keys per instrument in the first step of the first-seen state.
FIRST_SEEN_SALTS = 32


def route_and_land(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    received: Column | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Received messages to routed envelopes on storage."""
    return append_event_stream(route_messages(messages, received), root, checkpoint, available_now)


def connection_events(events: DataFrame) -> DataFrame:
    """Connects and disconnects among control messages, counted per connection."""
    event = F.get_json_object("payload_text", "$.event")
    return (
        events.where(F.col("channel") == "control")
        .select("connection_id", event.alias("event"))
        .where(F.col("event").isin("connected", "disconnected"))
        .groupBy("connection_id", "event")
        .agg(F.count(F.lit(1)).alias("times"))
    )


def first_seen_instruments(
    events: DataFrame,
    kinds: Sequence[str] = schemas.DERIVATIVES_KINDS,
    salts: int = FIRST_SEEN_SALTS,
) -> DataFrame:
    """Each listed or created instrument once, over the whole life of a stream of stored envelopes.

    The names are held in the state store and outlive restarts with the checkpoint. A name that
    fills the stream is first reduced within salted keys in several tasks; only the first sight
    per salt goes on to the second step, which decides for the name.
    """
    keep = ["salt"]
    salted = events.withColumn("salt", F.pmod(F.xxhash64("received_mts", "payload_text"), F.lit(salts)))
    control = salted.where(F.col("channel") == "control")
    creation = salted.where(F.col("channel") == "instrument_creation")
    names = discovered_instruments(control, kinds, keep).drop("pos").unionByName(
        newly_created_instruments(creation, kinds, keep)
    )
    return names.dropDuplicates(["instrument_name", "salt"]).select("instrument_name").dropDuplicates(
        ["instrument_name"]
    )


def subscriptions(
    instruments: DataFrame, interval: str = schemas.DEFAULT_TRADES_INTERVAL
) -> DataFrame:
    """The two channels to follow for each instrument."""
    channels = F.explode(instrument_channels(F.col("instrument_name"), interval))
    return instruments.select("instrument_name", channels.alias("channel"))


_FACTS = {"incremental_ticker": ticker_rows, "trades": trade_rows}


def fact_stream(events: DataFrame, dataset: str) -> DataFrame:
    """Ticker or trade rows of a stream of envelopes, without terms, with receipt day."""
    return _FACTS[dataset](with_receipt_day(events), keep=["date"])


def enriched_stream(events: DataFrame, instruments: DataFrame, dataset: str) -> DataFrame:
    """The same joined to stored terms."""
    enriched = attach_terms(fact_stream(events, dataset), instruments)
    return in_schema_order(enriched, schemas.DATASETS[dataset], keep=["date"])


def normalize_stream(
    events: DataFrame,
    instruments: DataFrame | Callable[[SparkSession], DataFrame],
    dataset: str,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    pending: str | None = None,
    give_up_ms: int | None = None,
) -> StreamingQuery:
    """Append enriched rows, per day of receipt and micro-batch.

    A function as `instruments` is called for every micro-batch, so that instruments stored meanwhile give
    their terms; a frame stays as it is when the stream starts. `path` belongs to streams alone, since the day
    plan replaces whole days.

    With `pending`, a root of this stream's own, rows without terms wait there and are joined again with every
    micro-batch until their terms are stored, or until they are `give_up_ms` older than the newest row. Call
    `finish_pending` once no more terms will come: rows then equal those of the day plan.
    """

    def write(batch: DataFrame, label: str) -> None:
        terms = instruments(batch.sparkSession) if callable(instruments) else instruments
        if pending is None:
            rows = enriched_stream(batch, terms, dataset)
        else:
            rows = settle(fact_stream(batch, dataset), terms, pending, label, give_up_ms)
        _store(rows, dataset, path, label)

    return each_batch(events, write, checkpoint, available_now)


def _store(rows: DataFrame, dataset: str, path: str, label: str) -> None:
    rows = in_schema_order(rows, schemas.DATASETS[dataset], keep=["date"])
    replace_parts(rows.withColumn("load", F.lit(label)), path, ("date", "load"))


def finish_pending(events: DataFrame, instruments: DataFrame, dataset: str, path: str, pending: str) -> None:
    """Store the rows that still wait, with terms where they exist by now; `events` only tells the columns.

    Call it while the stream is stopped. An interrupted call is repeated with the same outcome.
    """
    spark = events.sparkSession
    rows = release(spark, pending, instruments, fact_stream(events, dataset).schema)
    _store(rows, dataset, path, "last-" + hashlib.sha256(pending.encode()).hexdigest()[:12])
    forget(spark, pending)


def history_stream(
    pages: DataFrame,
    root: str,
    symbol: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Trades of newly landed pages, each trade id once, appended per trade day.

    The stream's checkpoint is the high-water mark: a page is read once. Which trades are new is told by the
    ids their days hold on storage, so the stream keeps no state, a late trade is stored like any other, and
    batch loads of the same root and the stream see each other's trades.
    """

    def write(batch: DataFrame, label: str) -> None:
        trades = unique_trades(page_trades(batch, symbol))
        append_new_trades(batch.sparkSession, to_stored(trades), root, symbol)

    return each_batch(pages, write, checkpoint, available_now)
