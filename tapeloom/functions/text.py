"""Scalar functions on symbols, decimals, instants and file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TRADE_DECIMAL = "decimal(38,18)"


def symbol_partition_name(symbol: Column) -> Column:
    """Directory name of a symbol: ASCII letters, digits, `-` and `_`, lower case; empty fails."""
    name = F.lower(F.regexp_replace(symbol, r"[^A-Za-z0-9_-]", "_"))
    return F.when(
        symbol == "", F.raise_error(F.lit("a symbol needs at least one character"))
    ).otherwise(name)


def decimal_text(value: Column) -> Column:
    """Plain decimal text without trailing fractional zeros."""
    text = value.cast(TRADE_DECIMAL).cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


# Plain numbers that decimal(38,18) holds whole: its cast then is exact, and much faster than moving digits.
_SHORT_NUMBER = r"^[0-9.+-]{1,19}$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,2})?$"


def parse_decimal(text: Column) -> Column:
    """Exact plain decimal text of a numeric text; null for anything else, blanks included.

    Nothing is rounded: digits are moved by the exponent and zeros that mean nothing are dropped, whatever the
    number of digits. An exponent may have two digits. Short plain numbers, nearly all there are, take a cast.
    """
    short = text.try_cast(TRADE_DECIMAL).cast("string")
    return F.when(text.rlike(_SHORT_NUMBER), F.rtrim(F.rtrim(short, F.lit("0")), F.lit("."))).otherwise(_moved_digits(text))


def _moved_digits(text: Column) -> Column:
    mantissa = F.regexp_replace(text, r"^[+-]|[eE].*$", "")
    exponent = F.coalesce(F.regexp_extract(text, r"[eE]([+-]?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    whole = F.substring_index(mantissa, ".", 1)
    digits = F.concat(F.repeat(F.lit("0"), 100), F.replace(mantissa, F.lit("."), F.lit("")), F.repeat(F.lit("0"), 100))
    point = F.length(whole) + exponent + 100
    before = F.regexp_replace(F.substring(digits, F.lit(1), point), "^0+", "")
    after = F.regexp_replace(F.substr(digits, point + 1), "0+$", "")
    size = F.concat(
        F.when(before == "", "0").otherwise(before), F.when(after == "", "").otherwise(F.concat(F.lit("."), after))
    )
    plain = F.when(text.startswith("-") & (size != "0"), F.concat(F.lit("-"), size)).otherwise(size)
    return F.when(text.rlike(_NUMBER), plain)


def absolute_decimal(value: Column) -> Column:
    """Size of a decimal text."""
    return F.ltrim(value, F.lit("-"))


def parse_integer(text: Column) -> Column:
    """64-bit integer of an integer text; null for anything else, `5.0` and blanks included."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def trade_side(amount: Column) -> Column:
    """Sign of an exact decimal text as a side; zero counts as buy."""
    return F.when(amount.startswith("-"), F.lit("sell")).otherwise(F.lit("buy"))


def parse_mts(text: Column) -> Column:
    """Epoch milliseconds of a digits-only text or an RFC 3339 instant with offset; else fails."""
    instant = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
    error = F.raise_error(
        F.concat(F.lit("neither epoch milliseconds nor an RFC 3339 instant: "), text)
    )
    return (
        F.when(text.isNull(), F.lit(None).cast("bigint"))
        .when(text.rlike(r"^[0-9]+$"), text.cast("bigint"))
        .when(text.rlike(instant), F.unix_millis(F.upper(text).cast("timestamp")))
        .otherwise(error)
    )


def parse_date(text: Column) -> Column:
    """Date of a `YYYY-MM-DD` text; anything else fails."""
    return F.to_date(text, "yyyy-MM-dd")


def mts_to_timestamp(mts: Column) -> Column:
    return F.timestamp_millis(mts)


def rfc3339_millis(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def rfc3339_seconds(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_date(instant: Column) -> Column:
    """UTC calendar day; the session zone is UTC."""
    return F.to_date(instant)


def daily_file_name(symbol_name: Column, day: Column) -> Column:
    return F.concat(symbol_name, F.lit("_"), _short_day(day), F.lit(".parquet"))


def daily_stream_file_name(symbol_name: Column, channel_name: Column, day: Column) -> Column:
    return F.concat(
        symbol_name, F.lit("_"), channel_name, F.lit("_"), _short_day(day), F.lit(".jsonl.zst")
    )


def normalized_file_name(dataset: Column, day: Column) -> Column:
    return F.concat(F.lit("btc_"), dataset, F.lit("_"), _short_day(day), F.lit(".parquet"))


def _short_day(day: Column) -> Column:
    return F.date_format(day, "yy-MM-dd")


def size_mib(length: Column) -> Column:
    return length / 1024 / 1024


def base64_text(payload: Column) -> Column:
    """Standard base64 in one line; Spark breaks long results into lines of 76 characters."""
    return F.replace(F.base64(payload), F.lit("\r\n"), F.lit(""))
