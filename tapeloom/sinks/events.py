"""Raw events on storage, routed by exchange, symbol, channel and UTC day of receipt.

Layout: <root>/exchange=<e>/symbol=<s>/channel=<c>/date=<day>/load=<label>/*.parquet
Spark has no zstd writer for text, so events are stored as zstd Parquet instead of JSON lines.

Batches and streams share a root: every load, and every micro-batch, has directories of its own. A micro-batch
is named by its query and number, so a repeated one replaces itself, and readers need no log of files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeloom import schemas

EVENT_PARTITIONS = ("exchange", "symbol", "channel", "date", "load")
# Files of this many rows are worth having; rows that would make smaller ones are brought together first.
LEAST_FILE_ROWS = 20_000


def with_receipt_day(events: DataFrame) -> DataFrame:
    return events.withColumn("date", F.to_date(F.timestamp_millis("received_mts")))


def _columns(events: DataFrame) -> DataFrame:
    return with_receipt_day(events).select(*schemas.ENVELOPE.names, "date")


def append_events(events: DataFrame, root: str, gather: bool = False, load: str | None = None) -> None:
    """Append envelopes; files of other loads stay. `load` names the load, a new one by default.

    By default nothing is shuffled and each task writes its own files, which suits input that
    arrives in time order. `gather` brings the rows of a directory together first, for input that
    mixes many days: small directories share a task, and one that holds most rows is split over
    several. Where the tasks hold enough rows of their directories, nothing is shuffled either.
    """
    rows = _columns(events).withColumn("load", F.lit(load or f"batch-{uuid.uuid4().hex}"))
    if gather and not _lie_together(rows, EVENT_PARTITIONS[:-1]):
        rows = rows.hint("rebalance", *EVENT_PARTITIONS)
    replace_parts(rows, root, EVENT_PARTITIONS)


def _lie_together(rows: DataFrame, partitions: Sequence[str]) -> bool:
    """Whether a task holds at least `LEAST_FILE_ROWS` rows of a directory, on average over all of both.

    Only the columns that name a directory are made for this, and a row for each task and directory is shuffled.
    """
    held = rows.groupBy(*partitions, F.spark_partition_id()).agg(F.count(F.lit(1)).alias("rows"))
    seen = held.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")).first()
    return seen["files"] * LEAST_FILE_ROWS <= (seen["rows"] or 0)


def replace_parts(rows: DataFrame, root: str, partitions: Sequence[str]) -> None:
    """Write the directories that the rows name, and leave all others."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**schemas.PARQUET_OPTIONS)
        .partitionBy(*partitions)
        .parquet(root)
    )


def each_batch(
    df: DataFrame,
    write: Callable[[DataFrame, str], None],
    checkpoint: str,
    available_now: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Run `write(rows, label)` on every micro-batch; the label is the same when a batch is repeated.

    The label names the query by the id that its checkpoint holds: a checkpoint that is lost and begun anew has another
    id, so that its micro-batches, counted from 0 again, replace nothing.
    """

    def labelled(rows: DataFrame, number: int) -> None:
        stored = rows.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
        write(rows, f"stream-{json.loads(stored['value'])['id']}-{number}")

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(labelled)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def append_event_stream(
    events: DataFrame, root: str, checkpoint: str, available_now: bool = False, interval: str = "1 minute"
) -> StreamingQuery:
    """The same as a stream; the day changes with the rows, so no file has to be rolled."""
    return each_batch(
        events, lambda rows, label: append_events(rows, root, load=label), checkpoint, available_now, interval
    )


def append_by_channel(events: DataFrame, roots: dict[str, str], rest: str | None = None) -> None:
    """Write each channel below a root of its own, and events of all other channels below `rest`.

    Without `rest`, events of a channel that has no root are an error, raised before anything is written. The
    events are scanned once per root, so give stored events.
    """
    if rest is None:
        without = [str(row["channel"]) for row in lost_channels(events, roots).limit(20).collect()]
        if without:
            raise ValueError(f"no root for the events of channels {', '.join(sorted(without))}")
    else:
        append_events(events.where(~_has_root(roots)), rest)
    for channel, root in roots.items():
        append_events(events.where(F.col("channel") == channel), root)


def _has_root(roots: Iterable[str]) -> Column:
    return F.coalesce(F.col("channel").isin(*roots), F.lit(False))


def lost_channels(events: DataFrame, roots: Iterable[str]) -> DataFrame:
    """Channels that `append_by_channel` has no root for, with their message counts."""
    return (
        events.where(~_has_root(roots))
        .groupBy("channel")
        .agg(F.count(F.lit(1)).alias("messages"))
    )
