"""Landed pages of trade history: JSON arrays of [id, mts, amount, price, ...] rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeloom import schemas
from tapeloom.functions.json_values import JSON_OPTIONS
from tapeloom.functions.text import parse_decimal, parse_integer


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pages as `page` text, one per line, with the file they came from."""
    return (
        spark.read.text(path)
        .where(F.trim("value") != "")
        .select(F.col("value").alias("page"), F.col("_metadata.file_path").alias("file_path"))
    )


def is_rate_limit_page(page: Column) -> Column:
    """True for the error object that stands in for a page when the request budget is spent."""
    error = F.from_json(page, "error variant", JSON_OPTIONS)["error"]
    text = F.when(F.schema_of_variant(error) == "STRING", error.cast("string"))
    return F.coalesce(page.contains("error") & (text == schemas.RATE_LIMIT_ERROR), F.lit(False))


def page_rows(pages: DataFrame, page: str = "page") -> DataFrame:
    """One row per trade of a page, with a verdict in `problem` (null when the row is good).

    Adds row_index, id, mts, amount, price, problem; a page that is no array gives one row with a
    problem. A page whose rows are not all arrays is read again row by row.
    """
    text = F.col(page)
    whole = F.from_json(text, "array<array<string>>", JSON_OPTIONS)
    # Row by row, with the JSON type of each row, so that a text is not taken for an array.
    texts = F.from_json(text, "array<string>", JSON_OPTIONS)
    types = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    by_row = F.transform(
        F.arrays_zip(texts.alias("text"), types.alias("type")),
        lambda row: F.when(
            F.schema_of_variant(row["type"]).startswith("ARRAY"),
            F.from_json(row["text"], "array<string>", JSON_OPTIONS),
        ),
    )
    unreadable = F.array(F.lit(None).cast("array<string>"))
    # An empty page stays an empty array and yields no row below.
    rows = F.coalesce(whole, by_row, F.when(text.isNotNull(), unreadable))
    others = [name for name in pages.columns if name != page]
    exploded = pages.select(*others, page, F.posexplode_outer(rows).alias("row_index", "fields"))
    fields = F.col("fields")
    typed = exploded.where("row_index is not null").select(
        *others,
        page,
        "row_index",
        "fields",
        parse_integer(F.get(fields, F.lit(0))).alias("id"),
        parse_integer(F.get(fields, F.lit(1))).alias("mts"),
        parse_decimal(F.get(fields, F.lit(2))).alias("amount"),
        parse_decimal(F.get(fields, F.lit(3))).alias("price"),
    )
    problem = (
        F.when(fields.isNull() & is_rate_limit_page(text), "rate limited page")
        .when(fields.isNull(), "not an array")
        .when(F.size(fields) < 4, "fewer than 4 fields")
        .when(F.col("id").isNull(), "ID is not an integer")
        .when(F.col("mts").isNull(), "MTS is not an integer")
        .when(F.col("amount").isNull(), "AMOUNT is not a decimal")
        .when(F.col("price").isNull(), "PRICE is not a decimal")
    )
    return typed.withColumn("problem", problem).drop("fields")


def good_rows(rows: DataFrame, on_bad: str = "fail", page: str = "page") -> DataFrame:
    """Rows without a problem. on_bad: "fail" stops the job on a bad row, "skip" leaves it out."""
    if on_bad == "skip":
        return rows.where("problem is null").drop("problem", page)
    if on_bad != "fail":
        raise ValueError("on_bad must be 'fail' or 'skip'")
    error = F.raise_error(
        F.concat(F.lit("trade row "), F.col("row_index").cast("string"), F.lit(": "), F.col("problem"))
    )
    return rows.where(F.when(F.col("problem").isNull(), True).otherwise(error)).drop("problem", page)


def bad_rows(rows: DataFrame) -> DataFrame:
    """The rows `good_rows` leaves out, with their problem, for a quarantine table."""
    return rows.where("problem is not null")
