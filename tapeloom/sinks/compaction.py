"""Compaction of stored history: small files of a day are put together while loads and readers go on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tapeloom import schemas
from tapeloom.sinks import history, snapshots

TARGET_BYTES = 512 << 20


def compact_history(
    spark: SparkSession,
    root: str,
    symbol: str,
    days: Sequence[dt.date] | None = None,
    target_bytes: int = TARGET_BYTES,
    least_files: int = 4,
) -> dict[dt.date, int]:
    """Put together the small files of days that hold `least_files` of them; returns how many went in per day.

    Small is what has less than half of `target_bytes`; larger files stay, so a byte is rewritten a logarithmic number
    of times. All days share one job, whose tasks follow the days and the bytes of large ones; files are sorted and in order within the day.
    Readers see the files of before until the new snapshot is published, and then those of after. Trades appended
    meanwhile are kept. A call that is interrupted changes nothing; one that meets another replacing writer raises
    `snapshots.Conflict` and changes nothing either.
    """
    base = history.history_path(root, symbol)
    before = snapshots.current(spark, base) or snapshots.Snapshot()
    wanted = None if days is None else {day.isoformat() for day in days}
    files: dict[str, list[str]] = {}
    runs: dict[str, list[str]] = {}
    taken: dict[str, int] = {}
    sizes: dict[str, int] = {}
    for day in snapshots.days_of(spark, base):
        if wanted is not None and day not in wanted:
            continue
        without = set(before.replaced.get(day, []))
        small = [f for f in snapshots.data_files(spark, f"{base}/date={day}") if f.name not in without and 2 * f.bytes < target_bytes]
        small_runs, count, held_bytes = [], len(small), sum(f.bytes for f in small)
        for run in before.runs.get(day, []):
            held = snapshots.data_files(spark, f"{snapshots.run_path(base, run)}/date={day}")
            size = sum(f.bytes for f in held)
            if 2 * size < target_bytes * len(held):
                small_runs, count, held_bytes = [*small_runs, run], count + len(held), held_bytes + size
        if count < max(least_files, 2) or count <= -(-held_bytes // target_bytes):
            continue
        files[day], runs[day], taken[day] = [f.name for f in small], small_runs, count
        sizes[day] = held_bytes
    if not taken:
        return {}
    rows = _rows(spark, base, files, runs)
    run = snapshots.new_run()
    # A task sorts a day, or a part of one that is larger than a file: days apart need no task that holds them all.
    whole_days = all(size <= target_bytes for size in sizes.values())
    parts = sum(max(1, -(-size // target_bytes)) for size in sizes.values())
    (
        rows.repartitionByRange(parts, *(["date"] if whole_days else ["date", "mts", "id"]))
        .sortWithinPartitions("date", "mts", "id")
        .write.options(**schemas.PARQUET_OPTIONS)
        .partitionBy("date")
        .parquet(snapshots.run_path(base, run))
    )
    written = set(snapshots.days_of(spark, snapshots.run_path(base, run)))  # a day of empty files has no rows to write
    new_runs, replaced = dict(before.runs), dict(before.replaced)
    for day in taken:
        kept = [name for name in before.runs.get(day, []) if name not in runs[day]]
        new_runs[day] = kept + [run] * (day in written)
        replaced[day] = sorted({*before.replaced.get(day, []), *files[day]})
    try:
        snapshots.publish(spark, base, before if before.number else None, new_runs, replaced)
    except snapshots.Conflict:
        snapshots.remove(spark, snapshots.run_path(base, run))
        raise
    return {dt.date.fromisoformat(day): count for day, count in taken.items()}


def _rows(spark: SparkSession, base: str, files: dict[str, list[str]], runs: dict[str, list[str]]) -> DataFrame:
    places = [f"{base}/date={day}/{name}" for day, names in files.items() for name in names]
    appended = spark.read.schema(history.STORED).option("basePath", base).parquet(*places) if places else None
    return snapshots.read_runs(spark, base, history.STORED, runs, appended)


def file_counts(spark: SparkSession, root: str, symbol: str) -> dict[dt.date, int]:
    """How many files hold the rows of each day."""
    base = history.history_path(root, symbol)
    snapshot = snapshots.current(spark, base) or snapshots.Snapshot()
    counts = {}
    for day in snapshots.days_of(spark, base):
        without = snapshot.replaced.get(day, [])
        count = sum(f.name not in without for f in snapshots.data_files(spark, f"{base}/date={day}"))
        for run in snapshot.runs.get(day, []):
            count += len(snapshots.data_files(spark, f"{snapshots.run_path(base, run)}/date={day}"))
        counts[dt.date.fromisoformat(day)] = count
    return counts


def remove_replaced(spark: SparkSession, root: str, symbol: str, older_than_ms: int) -> int:
    """Delete files that have not counted for `older_than_ms`; see `snapshots.remove_replaced`."""
    return snapshots.remove_replaced(spark, history.history_path(root, symbol), older_than_ms)
