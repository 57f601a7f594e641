"""Capture files: compressed JSON lines, one file per exchange, symbol, channel and UTC day of receipt.

Layout: <root>/<exchange>/<symbol>/<channel>/<symbol>_<channel>_<yy-mm-dd>.jsonl.gz
Spark has no zstd writer for text, so files are gzip; `sources.raw_capture` reads either.
A gzip file is read and written by one task, so a large file goes on in parts beside it (see `sources.raw_capture`).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tapeloom import schemas
from tapeloom.functions.text import symbol_partition_name
from tapeloom.sinks.events import with_receipt_day
from tapeloom.sources.raw_capture import MAX_PARTS, part_path, raw_file_path, whole_path

SUFFIX = ".jsonl.gz"
# Payload bytes of a part before compression, by which they shrink about tenfold.
PART_BYTES = 128 * 1024 * 1024
_PLACE = ("exchange_dir", "symbol_dir", "channel_dir", "day_dir")


def write_capture_files(events: DataFrame, root: str, order: Sequence[str] = ("received_mts",)) -> list[str]:
    """Write envelopes as capture files, the lines of a file in `order`; returns the paths, one per channel and day.

    A file appears whole, by a rename from a staging folder below `root`, and replaces an earlier one of its day. Days and
    channels are written side by side; one with more than `PART_BYTES` of payloads is cut into ranges of `order`, each the
    part of one task. The first part is put in place last, as the others do not count without it.
    """
    spark = events.sparkSession
    names = [symbol_partition_name(F.col(c)).alias(f"{c}_dir") for c in ("exchange", "symbol", "channel")]
    line = F.to_json(F.struct(*schemas.ENVELOPE.names)).alias("value")
    columns = list(dict.fromkeys([*order, *schemas.ENVELOPE.names]))
    payload = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("payload_text", "payload_base64")), F.lit(0).cast("bigint"))
    rows = with_receipt_day(events).select(*names, F.col("date").alias("day_dir"), *columns, payload.alias("payload_bytes"))
    # One row per channel and day. Folders by number keep the order of lines: by texts Spark would sort once more.
    sizes = rows.groupBy(*_PLACE).agg(F.sum("payload_bytes").alias("bytes")).orderBy(*_PLACE).collect()
    numbered = [(*(row[c] for c in _PLACE), number) for number, row in enumerate(sizes)]
    part_bytes = max(PART_BYTES, *[-(-row["bytes"] // MAX_PARTS) for row in sizes], 1)
    parts = sum(max(1, -(-row["bytes"] // part_bytes)) for row in sizes)
    numbers = spark.createDataFrame(numbered, "exchange_dir string, symbol_dir string, channel_dir string, day_dir date, file_no int")
    keys = ["file_no", *order]
    # Lines are made after the shuffle: their quoted payloads and names would cross it and be made for its bounds, too.
    placed = rows.join(F.broadcast(numbers), list(_PLACE)).select("file_no", *columns)
    placed = placed.repartition("file_no") if parts == len(numbered) else placed.repartitionByRange(parts, *keys)
    placed = placed.sortWithinPartitions(*keys).select("file_no", line)
    staging = f"{root.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    placed.write.partitionBy("file_no").option("compression", "gzip").text(staging)
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(staging).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    written = []
    for exchange, symbol, channel, date, number in numbered:
        sources = sorted(
            status.getPath().getName()
            for status in system.listStatus(hadoop.Path(f"{staging}/file_no={number}"))
            if status.getPath().getName().startswith("part-")
        )
        target = raw_file_path(root, channel, date, exchange, symbol, SUFFIX)
        _remove_parts(system, hadoop, target)
        for part, source in reversed(list(enumerate(sources))):  # tasks are numbered in the order of the lines
            place = hadoop.Path(part_path(target, part))
            if not system.rename(hadoop.Path(f"{staging}/file_no={number}/{source}"), place):
                raise OSError(f"cannot place {target}")
        written.append(target)
    system.delete(hadoop.Path(staging), True)
    return sorted(written)


def _remove_parts(system, hadoop, target: str) -> None:
    """Remove an earlier file, its first part first; its folder is there afterwards."""
    folder, name = target.rsplit("/", 1)
    system.mkdirs(hadoop.Path(folder))
    earlier = [status.getPath().getName() for status in system.listStatus(hadoop.Path(folder))]
    for _, found in sorted((whole_path(found)[1], found) for found in earlier if whole_path(found)[0] == name):
        system.delete(hadoop.Path(f"{folder}/{found}"), False)
