"""Raw captures: compressed JSON lines, one envelope per line.

Layout read: <root>/<exchange>/<symbol>/<channel>/<symbol>_<channel>_<yy-mm-dd>.jsonl.zst, also .jsonl.gz and .jsonl
A large file goes on in parts beside it, `<symbol>_<channel>_<yy-mm-dd>.part-00001.jsonl.gz` and so on; its own name is the
first of them, and without that the others do not count.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeloom import schemas
from tapeloom.functions.json_values import parse_json_column
from tapeloom.functions.text import base64_text, rfc3339_millis

# One chunk of lines stays together when a wide file is spread over tasks. Captures compress about
# tenfold, so a task of this many compressed bytes parses a usual split's worth of JSON; below the
# smaller bound a shuffle costs more than it saves.
SPREAD_CHUNK_LINES = 5_000
SPREAD_TASK_BYTES = 16 * 1024 * 1024
SPREAD_FROM_BYTES = 4 * 1024 * 1024

# As recorded, as `sinks.capture_files` writes them, and unpacked.
SUFFIXES = (".jsonl.zst", ".jsonl.gz", ".jsonl")

_PART = re.compile(r"\.part-(\d+)(?=\.jsonl)")
# A part's place in its file stands above the bits of `monotonically_increasing_id`.
PART_BITS, MAX_PARTS = 52, 2_000

LINE_COLUMNS = "value string, line_no bigint, file_path string, date date"


@dataclass(frozen=True)
class RawFile:
    path: str
    channel: str
    date: dt.date
    size: int
    part: int = 0


def partition_name(symbol: str) -> str:
    """`functions.text.symbol_partition_name` for a single argument on the driver."""
    if not symbol:
        raise ValueError("a symbol needs at least one character")
    return re.sub(r"[^A-Za-z0-9_-]", "_", symbol).lower()


def raw_file_path(root: str, channel: str, day: dt.date, exchange: str, symbol: str, suffix: str = SUFFIXES[0]) -> str:
    exchange, symbol, channel = (partition_name(part) for part in (exchange, symbol, channel))
    name = f"{symbol}_{channel}_{day:%y-%m-%d}{suffix}"
    return f"{root.rstrip('/')}/{exchange}/{symbol}/{channel}/{name}"


def part_path(path: str, part: int) -> str:
    """Where a part of a capture file lies; part 0 has the file's own name."""
    stem, suffix = re.fullmatch(r"(.*?)(\.jsonl[^/]*)", path).groups()
    return f"{stem}.part-{part:05d}{suffix}" if part else path


def whole_path(path: str) -> tuple[str, int]:
    """The capture file that a path belongs to, and the number of the part."""
    part = _PART.search(path)
    return _PART.sub("", path), int(part.group(1)) if part else 0


def list_raw_files(
    spark: SparkSession,
    root: str,
    dates: Iterable[dt.date],
    channels: Sequence[str] = schemas.NORMALIZE_CHANNELS,
    exchange: str = schemas.DERIVATIVES_EXCHANGE,
    symbol: str = schemas.DERIVATIVES_SYMBOL,
) -> list[RawFile]:
    """The existing files of the given channels and days, with their parts; one directory listing per channel.

    A day that has a channel in two forms is an error, since its lines would count twice, and so is a missing part.
    """
    days = sorted(set(dates))
    found = []
    for channel in channels:
        wanted = {}
        for day in days:
            for suffix in SUFFIXES:
                path = raw_file_path(root, channel, day, exchange, symbol, suffix)
                wanted[path.rsplit("/", 1)[1]] = (path, day)
        directory = path.rsplit("/", 1)[0] if days else None
        if directory is None:
            continue
        forms: dict[str, dict[int, int]] = {}
        for name, size in _directory_files(spark, directory):
            whole, part = whole_path(name)
            if whole in wanted:
                forms.setdefault(whole, {})[part] = size
        seen = set()
        for whole, parts in forms.items():
            path, day = wanted[whole]
            if 0 not in parts:
                continue
            if day in seen:
                raise ValueError(f"{channel} of {day} lies in several forms below {directory}")
            seen.add(day)
            if sorted(parts) != list(range(len(parts))):
                raise FileNotFoundError(f"a part of {path} is missing")
            found += [RawFile(part_path(path, part), channel, day, parts[part], part) for part in sorted(parts)]
    return found


def _directory_files(spark: SparkSession, directory: str) -> list[tuple[str, int]]:
    """Names and sizes of a directory's files; a missing directory is empty."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(path):
        return []
    return [(s.getPath().getName(), s.getLen()) for s in system.listStatus(path) if s.isFile()]


def stored_bytes(spark: SparkSession, location: str) -> int:
    """Bytes below a path, from the file system's own summary."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return path.getFileSystem(conf).getContentSummary(path).getLength()


def require_files(files: Sequence[RawFile], dates: Iterable[dt.date], root: str) -> None:
    """A day without any of its files is an error; a day with some reads the others as empty."""
    missing = sorted(set(dates) - {file.date for file in files})
    if missing:
        days = ", ".join(str(day) for day in missing)
        raise FileNotFoundError(f"no raw files found for {days} under {root}")


def read_raw_lines(
    spark: SparkSession,
    files: Sequence[RawFile],
    cut_tails: str | Iterable[str] = (),
    spread: bool | None = None,
) -> DataFrame:
    """Non-blank lines with their order: value, line_no, file_path, date.

    A compressed file, or a part of one, is read by one task, so `line_no`, taken right after the scan, grows with
    the line order of each file, its part above all. `cut_tails` names files (or "all") whose incomplete compressed
    tail ends the file quietly with the whole lines before it kept; other files fail on it.
    `spread` distributes the lines for parsing; by default only when they are large enough to be worth a
    shuffle and there are fewer files than cores, or one holds over twice a core's share of all bytes.
    """
    if not files:
        return spark.createDataFrame([], LINE_COLUMNS)
    tolerant = {f.path for f in files} if cut_tails == "all" else set(cut_tails)
    strict_paths = [f.path for f in files if f.path not in tolerant]
    tolerant_paths = [f.path for f in files if f.path in tolerant]
    parts = []
    if strict_paths:
        parts.append(spark.read.option("ignoreCorruptFiles", "false").text(strict_paths))
    if tolerant_paths:
        parts.append(spark.read.option("ignoreCorruptFiles", "true").text(tolerant_paths))
    lines = _with_order(parts[0])
    for part in parts[1:]:
        lines = lines.unionByName(_with_order(part))
    lines = without_blank_lines(lines)

    total = sum(f.size for f in files)
    cores = spark.sparkContext.defaultParallelism
    if spread is None:
        uneven = max(f.size for f in files) > 2 * total / cores
        spread = total > SPREAD_FROM_BYTES and (len(files) < cores or uneven)
    if spread:
        tasks = max(cores, -(-total // SPREAD_TASK_BYTES))
        chunk = F.floor(F.col("line_no") / SPREAD_CHUNK_LINES)
        lines = lines.repartition(int(tasks), "file_path", chunk)
    return lines


def without_blank_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.trim("value") != "")


def _with_order(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        (F.monotonically_increasing_id() + F.shiftleft(file_part(F.col("_metadata.file_name")), PART_BITS)).alias("line_no"),
        F.col("_metadata.file_path").alias("file_path"),
        file_day(F.col("_metadata.file_name")).alias("date"),
    )


def file_day(file_name: Column) -> Column:
    """UTC day in a capture file name."""
    return F.try_to_timestamp(
        F.regexp_extract(file_name, r"_(\d{2}-\d{2}-\d{2})(?:\.part-\d+)?\.jsonl", 1), F.lit("yy-MM-dd")
    ).cast("date")


def file_part(path: Column) -> Column:
    """Number of the part in a capture file's path, 0 in a file's own name."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(path, _PART.pattern, 1), F.lit("")), F.lit("99999")).cast("bigint"), F.lit(0).cast("bigint"))


def whole_file(path: Column) -> Column:
    """`whole_path` of a column of paths."""
    return F.regexp_replace(path, _PART.pattern, "")


def parse_envelopes(lines: DataFrame, text: str = "value", on_bad: str = "fail") -> DataFrame:
    """Envelope columns of each line, next to the other columns.

    on_bad: "fail" stops the job on a line that is not an envelope with its six required fields,
    naming the file; "keep" adds `envelope_ok` instead.
    """
    required = schemas.required_columns(schemas.ENVELOPE)
    parsed = parse_json_column(lines, text, schemas.ENVELOPE.simpleString(), "envelope")
    valid = F.lit(True)
    for name in required:
        valid = valid & F.col(f"envelope.{name}").isNotNull()
    others = [name for name in lines.columns if name != text]
    if on_bad == "fail":
        place = F.col("file_path") if "file_path" in lines.columns else F.lit("input")
        error = F.raise_error(F.concat(F.lit("invalid capture envelope in "), place, F.lit(": "), F.col(text)))
        return parsed.where(F.when(valid, True).otherwise(error)).select(*others, "envelope.*")
    if on_bad == "keep":
        return parsed.select(
            *others, text, F.coalesce(valid, F.lit(False)).alias("envelope_ok"), "envelope.*"
        )
    raise ValueError("on_bad must be 'fail' or 'keep'")


def text_events(events: DataFrame) -> DataFrame:
    """Events with a text payload; binary frames are skipped."""
    return events.where(F.col("payload_text").isNotNull())


def read_raw_events(
    spark: SparkSession,
    files: Sequence[RawFile],
    cut_tails: str | Iterable[str] = (),
    spread: bool | None = None,
) -> DataFrame:
    """Text events of capture files: scan, drop blank lines, parse, skip binary frames."""
    return text_events(parse_envelopes(read_raw_lines(spark, files, cut_tails, spread)))


def read_landed_events(spark: SparkSession, root: str) -> DataFrame:
    """Events landed by `sinks.events`, with an order of receipt in `line_no`.

    The order is by time of receipt, then by file and by row within the file.
    """
    stored = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.ENVELOPE)
    events = spark.read.schema(f"{stored}, date date").parquet(root).drop("load")
    order = F.struct(
        "received_mts",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.row_index").alias("row_index"),
    )
    return events.withColumn("line_no", order)


def build_envelopes(messages: DataFrame, received: Column | None = None) -> DataFrame:
    """Envelope columns of received frames.

    Columns read: exchange, symbol, channel, connection_id, and `text` and/or `binary` frames.
    `received` is the instant of receipt, the current time by default. Other columns stay.
    """
    instant = F.current_timestamp() if received is None else received
    text = F.col("text") if "text" in messages.columns else F.lit(None).cast("string")
    binary = F.col("binary") if "binary" in messages.columns else F.lit(None).cast("binary")
    rest = [c for c in messages.columns if c not in {*schemas.ENVELOPE.names, "text", "binary"}]
    return messages.select(
        *rest,
        rfc3339_millis(instant).alias("received_at"),
        F.unix_millis(instant).alias("received_mts"),
        "exchange",
        "symbol",
        "channel",
        "connection_id",
        text.alias("payload_text"),
        base64_text(binary).alias("payload_base64"),
    )


def envelope_lines(events: DataFrame) -> DataFrame:
    """Envelopes as JSON lines; absent payloads are left out."""
    return events.select(F.to_json(F.struct(*schemas.ENVELOPE.names)).alias("value"))


def count_by_channel(events: DataFrame) -> DataFrame:
    """Events with a text payload per channel."""
    return text_events(events).groupBy("channel").agg(F.count(F.lit(1)).alias("events"))


def count_by_file(lines: DataFrame) -> DataFrame:
    """Lines read per file, to see what a tolerated cut tail left."""
    return lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("lines"))


def count_by_feed(events: DataFrame) -> DataFrame:
    """Messages per feed."""
    return events.groupBy("exchange", "symbol", "channel").agg(F.count(F.lit(1)).alias("messages"))
