"""Load trade history from landed pages into daily datasets, resuming after the last completed day."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tapeloom import schemas
from tapeloom.operators.quality import check_history_arguments
from tapeloom.operators.trades import (
    derive_trades,
    first_trades,
    in_time_range,
    recent_page,
    unique_trades,
)
from tapeloom.sinks.history import (
    last_completed_day,
    load_checkpoint,
    read_history,
    save_checkpoint,
    to_stored,
    write_history,
)
from tapeloom.session import materialize
from tapeloom.sources.trade_pages import good_rows, page_rows


@dataclass(frozen=True)
class HistorySummary:
    rows: int
    start: int | None
    checkpoint: dict | None


def page_trades(pages: DataFrame, symbol: str, on_bad: str = "fail") -> DataFrame:
    """Trades of landed pages."""
    return derive_trades(good_rows(page_rows(pages), on_bad), symbol)


def resolve_start(requested: int | None, checkpoint: dict | None) -> int | None:
    """`functions.cursor.resolve_start` for one load."""
    starts = [requested, checkpoint["next_start_mts"] if checkpoint else None]
    return max((start for start in starts if start is not None), default=None)


def load_history(
    spark: SparkSession,
    pages: DataFrame,
    root: str,
    symbol: str = schemas.HISTORY_DEFAULT_SYMBOL,
    start: int | None = None,
    end: int | None = None,
    limit: int = 1_000,
    max_trades: int | None = None,
    ignore_checkpoint: bool = False,
    on_bad: str = "fail",
) -> HistorySummary:
    """One load. Without a start and without a checkpoint it stores the most recent page only.

    With a known start it stores every trade from there to `end`, at most `max_trades`, replaces
    the days it holds, and saves the newest day before the last one as completed. A recent page
    saves no checkpoint, because the beginning of its first day is unknown.
    """
    check_history_arguments(symbol, start, end, limit, max_trades)
    checkpoint = None if ignore_checkpoint else load_checkpoint(spark, root, symbol)
    first_mts = resolve_start(start, checkpoint)
    if first_mts is not None and end is not None and first_mts > end:
        return HistorySummary(0, first_mts, checkpoint)

    trades = page_trades(pages, symbol, on_bad)
    if first_mts is None:
        rows, _ = write_history(
            to_stored(recent_page(unique_trades(trades), limit, end, max_trades)), root, symbol
        )
        return HistorySummary(rows, None, None)

    # The range goes first, so rows outside it are not shuffled.
    new = to_stored(first_trades(unique_trades(in_time_range(trades, first_mts, end)), max_trades))
    boundary = dt.date.fromisoformat(checkpoint["last_completed_date"]) if checkpoint else None
    if boundary is not None:
        rows, newest = _write_after(spark, new, root, symbol, boundary, first_mts)
    else:
        rows, newest = write_history(new, root, symbol)
    if newest is None:
        return HistorySummary(rows, first_mts, checkpoint)

    first_day = dt.datetime.fromtimestamp(first_mts / 1000, dt.timezone.utc).date()
    completed = last_completed_day(spark, root, symbol, first_day, newest)
    if completed is not None:
        checkpoint = save_checkpoint(spark, root, symbol, *completed)
    return HistorySummary(rows, first_mts, checkpoint)


def _write_after(spark, new: DataFrame, root: str, symbol: str, boundary: dt.date, first_mts: int):
    """Write the days after a completed day; trades that arrived late for that day join its rows.

    Late trades are rare, so they are only counted while the newer days are written. When there
    are some, the completed day is rewritten as its stored rows plus the late ones.
    """
    late = Observation()
    is_late = F.col("date") <= F.lit(boundary)
    watched = new.observe(late, F.count_if(is_late).alias("rows"))
    rows, newest = write_history(watched.where(~is_late), root, symbol)
    if late.get.get("rows"):
        stored = read_history(spark, root, symbol).where(
            (F.col("date") == F.lit(boundary)) & (F.col("mts") < first_mts)
        )
        # The merged day is stored before its old files go.
        merged = materialize(spark, stored.unionByName(new.where(is_late)), "merged-day")
        whole, _ = write_history(merged, root, symbol)
        rows += whole
        newest = newest or boundary
    return rows, newest
