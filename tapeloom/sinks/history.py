"""Trade history on storage: one directory per symbol and UTC day, and completed-day checkpoints.

Layout: <root>/<symbol partition>/date=<day>/*.parquet
        <root>/<symbol partition>/_checkpoints/save=<number>/*.json
        <root>/<symbol partition>/_snapshots/, once the history has been compacted (see `sinks.snapshots`)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tapeloom import schemas
from tapeloom.operators.quality import check_checkpoint
from tapeloom.operators.trades import last_trades_by_day, stored_form, with_date
from tapeloom.session import materialize
from tapeloom.sinks import snapshots
from tapeloom.sources.raw_capture import partition_name


def _ddl(schema) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)


STORED = f"{_ddl(schemas.TRADES)}, date date"


def history_path(root: str, symbol: str) -> str:
    return f"{root.rstrip('/')}/{partition_name(symbol)}"


def path_exists(spark: SparkSession, location: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return path.getFileSystem(conf).exists(path)


def read_history(spark: SparkSession, root: str, symbol: str) -> DataFrame:
    """Stored trades with their `date`; a time range on `mts` reaches the scan."""
    return snapshots.read_days(spark, history_path(root, symbol), STORED)


def stored_extents(spark: SparkSession, root: str, symbol: str) -> DataFrame:
    """Stored trades and their first and last instant per day (`date`, `rows`, `first`, `last`), from file footers."""
    return snapshots.day_extents(spark, history_path(root, symbol), STORED, "mts")


def write_history(
    stored: DataFrame, root: str, symbol: str, row_group_bytes: int | None = None
) -> tuple[int, dt.date | None]:
    """Write stored-form trades with `date`, replacing the days they hold; returns rows and newest day.

    Days are cut into ranges of time and id, so a day of any size is written by several tasks,
    each file sorted and the files of a day in order. In a compacted history the days are replaced by a snapshot,
    at once for all readers; a load that meets a compaction fails with `snapshots.Conflict` and is to be repeated.
    """
    spark, base = stored.sparkSession, history_path(root, symbol)
    before = snapshots.current(spark, base)
    run = snapshots.new_run()
    options = dict(schemas.PARQUET_OPTIONS)
    if row_group_bytes is not None:
        options["parquet.block.size"] = str(row_group_bytes)
    metrics = Observation()
    ordered = (
        stored.select(*schemas.TRADES.names, "date")
        .repartitionByRange("date", "mts", "id")
        .sortWithinPartitions("date", "mts", "id")
        .observe(metrics, F.count(F.lit(1)).alias("rows"), F.max("date").alias("newest"))
    )
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy("date")
        .parquet(base if before is None else snapshots.run_path(base, run))
    )
    if before is not None:
        snapshots.publish_days(spark, base, before, run)
    elif snapshots.current(spark, base) is not None:
        raise snapshots.Conflict(f"{base} was compacted during the load")
    return metrics.get["rows"], metrics.get["newest"]


def append_new_trades(spark: SparkSession, stored: DataFrame, root: str, symbol: str) -> int:
    """Add the trades whose id their day does not hold yet; returns how many.

    Nothing stored is rewritten, so an interrupted call loses nothing, and a repeated one adds only what the
    first left out. Only the ids of the days that the new trades fall on are read.
    """
    new = materialize(spark, stored.select(*schemas.TRADES.names, "date"), "new-trades")
    days = [row["date"] for row in new.select("date").distinct().collect()]  # one row per calendar day
    if not days:
        return 0
    if path_exists(spark, history_path(root, symbol)):
        held = read_history(spark, root, symbol).where(F.col("date").isin(*days)).select("date", "id")
        new = new.join(held, ["date", "id"], "left_anti")
    metrics = Observation()
    ordered = (
        new.select(*schemas.TRADES.names, "date")
        .repartitionByRange("date", "mts", "id")
        .sortWithinPartitions("date", "mts", "id")
        .observe(metrics, F.count(F.lit(1)).alias("rows"))
    )
    ordered.write.mode("append").options(**schemas.PARQUET_OPTIONS).partitionBy("date").parquet(history_path(root, symbol))
    return metrics.get["rows"]


def stored_days(spark: SparkSession, root: str, symbol: str) -> list[dt.date]:
    """Days that have a directory, ascending; no data is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(history_path(root, symbol))
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path) if status.isDirectory()]
    return sorted(dt.date.fromisoformat(name.removeprefix("date=")) for name in names if name.startswith("date="))


def to_stored(trades: DataFrame) -> DataFrame:
    """Stored form and day of derived trades."""
    return with_date(stored_form(trades))


# Checkpoints -----------------------------------------------------------------------------------


def _checkpoint_dir(root: str, symbol: str) -> str:
    return f"{history_path(root, symbol)}/_checkpoints"


def _saved(spark: SparkSession, root: str, symbol: str) -> dict | None:
    location = _checkpoint_dir(root, symbol)
    if not path_exists(spark, location):
        return None
    saved = spark.read.schema(f"{_ddl(schemas.CHECKPOINT)}, save bigint").json(location)
    row = saved.orderBy(F.desc("save")).first()
    return None if row is None else row.asDict()


def load_checkpoint(spark: SparkSession, root: str, symbol: str) -> dict | None:
    """The newest saved checkpoint of a symbol, checked; None when there is none."""
    row = _saved(spark, root, symbol)
    if row is None:
        return None
    row.pop("save")
    return check_checkpoint(row, symbol, partition_name(symbol))


def save_checkpoint(
    spark: SparkSession, root: str, symbol: str, completed: dt.date, last_mts: int, last_id: int
) -> dict:
    """Save a completed day. Each save is a new directory, so an interrupted save changes nothing."""
    checkpoint = {
        "version": schemas.CHECKPOINT_VERSION,
        "exchange": schemas.HISTORY_EXCHANGE,
        "symbol": symbol,
        "symbol_partition": partition_name(symbol),
        "last_completed_date": completed.isoformat(),
        "last_trade_mts": last_mts,
        "last_trade_id": last_id,
        "next_start_mts": last_mts + 1,
        "updated_at": dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
    }
    before = _saved(spark, root, symbol)
    number = 0 if before is None else before["save"] + 1
    row = spark.createDataFrame([checkpoint], schemas.CHECKPOINT)
    row.coalesce(1).write.json(f"{_checkpoint_dir(root, symbol)}/save={number}")
    return checkpoint


def last_completed_day(
    spark: SparkSession, root: str, symbol: str, first: dt.date, newest: dt.date
) -> tuple[dt.date, int, int] | None:
    """Newest stored day in [first, newest) with its last trade; `newest` itself may still grow."""
    for day in reversed([day for day in stored_days(spark, root, symbol) if first <= day < newest]):
        trades = read_history(spark, root, symbol).where(F.col("date") == F.lit(day)).drop("date")
        last = last_trades_by_day(trades).first()
        if last is not None:  # a directory may hold no rows
            return day, last["last_trade_mts"], last["last_trade_id"]
    return None
