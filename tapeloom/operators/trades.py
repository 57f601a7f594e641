"""Trade history: derivation, range, order, limits, daily aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tapeloom import schemas
from tapeloom.functions.text import absolute_decimal, mts_to_timestamp, rfc3339_millis, trade_side, utc_date
from tapeloom.operators.ranking import TOP_K_ROWS, first_rows


def derive_trades(
    rows: DataFrame,
    symbol: str = schemas.HISTORY_DEFAULT_SYMBOL,
    exchange: str = schemas.HISTORY_EXCHANGE,
) -> DataFrame:
    """Trades of parsed page rows: exchange, symbol, id, mts, timestamp, side and three exact decimal texts.

    A `symbol` column in the rows wins over the argument.
    """
    if not symbol:
        raise ValueError("trades need a symbol")
    name = F.col("symbol") if "symbol" in rows.columns else F.lit(symbol)
    return rows.select(
        F.lit(exchange).alias("exchange"),
        name.alias("symbol"),
        "id",
        "mts",
        mts_to_timestamp(F.col("mts")).alias("timestamp"),
        trade_side(F.col("amount")).alias("side"),
        "amount",
        absolute_decimal(F.col("amount")).alias("amount_abs"),
        "price",
    )


def unique_trades(trades: DataFrame) -> DataFrame:
    """One row per symbol and trade id, for pages that overlap.

    Copies collapse on the map side. Copies that differ resolve to the smallest by time, amount
    and price, so reruns agree.
    """
    rest = [name for name in trades.columns if name not in ("exchange", "symbol", "id")]
    kept = trades.groupBy("exchange", "symbol", "id").agg(
        F.min_by(F.struct(*rest), F.struct("mts", "amount", "price")).alias("kept")
    )
    return kept.select(
        *[
            F.col(name) if name in ("exchange", "symbol", "id") else F.col(f"kept.{name}").alias(name)
            for name in trades.columns
        ]
    )


def check_range(start: int | None, end: int | None) -> None:
    if start is not None and end is not None and start > end:
        raise ValueError(f"the range ends ({end}) before it starts ({start})")


def in_time_range(trades: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Trades with start <= mts <= end; either bound may be open."""
    check_range(start, end)
    if start is not None:
        trades = trades.where(F.col("mts") >= start)
    if end is not None:
        trades = trades.where(F.col("mts") <= end)
    return trades


def sorted_trades(trades: DataFrame) -> DataFrame:
    return trades.orderBy("mts", "id")


def first_trades(trades: DataFrame, max_trades: int | None, top_k_rows: int = TOP_K_ROWS) -> DataFrame:
    """The first trades by time and id; no limit when `max_trades` is None."""
    if max_trades is None:
        return trades
    if max_trades <= 0:
        raise ValueError(f"max_trades has to be positive, not {max_trades}")
    return first_rows(trades, ["mts", "id"], max_trades, top_k_rows)


def recent_page(
    trades: DataFrame, limit: int = 1_000, end: int | None = None, max_trades: int | None = None
) -> DataFrame:
    """The newest `limit` trades up to `end`, oldest first; then at most `max_trades` of them."""
    if not 1 <= limit <= schemas.MAX_PAGE_TRADES:
        raise ValueError(f"a page holds 1 to {schemas.MAX_PAGE_TRADES} trades, not {limit}")
    page = first_rows(in_time_range(trades, end=end), ["mts", "id"], limit, descending=True)
    return sorted_trades(first_trades(page, max_trades))


def stored_form(trades: DataFrame) -> DataFrame:
    """Trades as stored: instants as text, in the order of the schema."""
    return trades.withColumn("timestamp", rfc3339_millis(F.col("timestamp"))).select(*schemas.TRADES.names)


def with_date(trades: DataFrame) -> DataFrame:
    """Add the UTC trade day."""
    return trades.withColumn("date", utc_date(mts_to_timestamp(F.col("mts"))))


def daily_counts(trades: DataFrame) -> DataFrame:
    return with_date(trades).groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("trades"))


def total_count(trades: DataFrame) -> DataFrame:
    return trades.agg(F.count(F.lit(1)).alias("trades"))


def max_mts(trades: DataFrame) -> DataFrame:
    """Newest trade time per symbol, the base of the next cursor."""
    return trades.groupBy("symbol").agg(F.max("mts").alias("max_mts"))


def last_trades_by_day(trades: DataFrame) -> DataFrame:
    """Last trade (time, then id) of every symbol and day."""
    last = with_date(trades).groupBy("symbol", "date").agg(F.max(F.struct("mts", "id")).alias("last"))
    return last.select(
        "symbol",
        "date",
        F.col("last.mts").alias("last_trade_mts"),
        F.col("last.id").alias("last_trade_id"),
    )


def last_trades_of_completed_days(trades: DataFrame) -> DataFrame:
    """The same without each symbol's newest day, which may still grow."""
    newest = F.max("date").over(Window.partitionBy("symbol"))
    days = last_trades_by_day(trades)
    # One row per symbol and day is left by now, so the window holds calendar days only.
    return days.withColumn("newest", newest).where(F.col("date") < F.col("newest")).drop("newest")
