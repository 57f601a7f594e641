"""Streaming sources: landing directories of message lines, envelope lines and history pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeloom.functions.json_values import parse_json_column

# A received message in a landing directory, one JSON object per line.
MESSAGE_LINE = (
    "struct<exchange: string, symbol: string, channel: string, connection_id: string, text: string>"
)


def line_stream(spark: SparkSession, directory: str, max_files: int = 1_000) -> DataFrame:
    """New files of a directory as `value` lines; compressed files are read as they are."""
    lines = spark.readStream.option("maxFilesPerTrigger", str(max_files)).text(directory)
    return lines.where(F.trim("value") != "")


def kafka_lines(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Messages of a topic as `value` lines; needs the Kafka connector on the class path."""
    topic_stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return topic_stream.option("subscribe", topic).load().select(F.col("value").cast("string").alias("value"))


def message_stream(lines: DataFrame) -> DataFrame:
    """Received messages of a line stream."""
    return parse_json_column(lines, "value", MESSAGE_LINE, "line").select("line.*")


def page_stream(spark: SparkSession, directory: str, max_files: int = 1_000) -> DataFrame:
    """History pages as they land."""
    return line_stream(spark, directory, max_files).select(F.col("value").alias("page"))
