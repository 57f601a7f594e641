"""Capture files as rows: where they are, how new and how large, and their first lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeloom.functions.text import size_mib
from tapeloom.sources.raw_capture import parse_envelopes, whole_file, whole_path

CAPTURE_PATTERN = "*.{jsonl,jsonl.gz,jsonl.zst}"


def capture_files(spark: SparkSession, root: str, pattern: str = CAPTURE_PATTERN) -> DataFrame:
    """exchange, symbol, channel, modified_at, size_mb, path of every capture file below root.

    File contents are not read: only path, time and length are selected. The parts of a file are one row.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    whole = files.select("path", "modificationTime", "length").groupBy(whole_file(F.col("path")).alias("whole")).agg(
        F.max("modificationTime").alias("modified_at"),
        F.sum("length").alias("length"),
        F.bool_or(F.col("path") == whole_file(F.col("path"))).alias("complete"),
    )
    return whole.where("complete").select(
        *capture_parts(F.col("whole"), root),
        "modified_at",
        size_mib(F.col("length")).alias("size_mb"),
        F.col("whole").alias("path"),
    )


def capture_parts(path: Column, root: str) -> list[Column]:
    """exchange, symbol and channel from the path below root; null with fewer than four parts."""
    prefix = "/" + root.split("://")[-1].removeprefix("file:").strip("/") + "/"
    below = F.get(F.split(path, re.escape(prefix), 2), F.lit(1))
    parts = F.split(below, "/")
    return [
        F.when(F.size(parts) >= 4, F.get(parts, F.lit(i))).alias(name)
        for i, name in enumerate(("exchange", "symbol", "channel"))
    ]


def file_head(spark: SparkSession, path: str, rows: int = 5) -> DataFrame:
    """Envelopes of the first non-blank lines of one file.

    One compressed file is one partition, so the limit takes lines in file order. Every part of a file has a line at
    least, so as many parts as rows are enough.
    """
    if rows <= 0:
        raise ValueError("rows must be greater than zero")
    heads = [_first_lines(spark, part, rows) for part in _parts(spark, path)[:rows]]
    if len(heads) == 1:
        return parse_envelopes(heads[0])
    lines = None
    for number, head in enumerate(heads):
        head = head.select("value", F.lit(number).alias("part"), F.monotonically_increasing_id().alias("row"))
        lines = head if lines is None else lines.unionByName(head)
    return parse_envelopes(lines.orderBy("part", "row").limit(rows).select("value"))


def _first_lines(spark: SparkSession, path: str, rows: int) -> DataFrame:
    text = spark.read.option("ignoreCorruptFiles", "true").text(path)
    return text.where(F.trim("value") != "").limit(rows)


def _parts(spark: SparkSession, path: str) -> list[str]:
    """The paths of a capture file's parts in their order; the file's own first."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    siblings = [status.getPath().getName() for status in system.listStatus(place.getParent())]
    parts = [(whole_path(name)[1], name) for name in siblings if whole_path(name) == (place.getName(), whole_path(name)[1])]
    folder = path.rsplit("/", 1)[0]
    return [path, *[f"{folder}/{name}" for number, name in sorted(parts) if number]]
