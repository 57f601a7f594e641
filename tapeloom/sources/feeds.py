"""Feed catalogue: which exchange, symbol and channel combinations a capture should hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeloom import schemas

FEED_COLUMNS = (
    "venue string, exchange string, symbol string, channel string, connection_id string,"
    " topics array<string>"
)

# Channels per venue, and the topics of the venue with one shared channel.
HISTORY_CHANNELS = ("book_l25", "trades")
PERPETUAL_CHANNELS = ("orderbook", "trades", "funding", "mark_price", "index_price")
SPOT_CHANNELS = ("orderbook", "trades")
SHARED_TOPICS = (
    "mark_price",
    "spot_price",
    "funding_rate_estimation",
    "trades",
    "orderbook",
    "ask_bid_price",
)
DEFAULT_SYMBOLS = {
    "bitfinex": "tBTCUSD",
    "extended": "BTC-USD",
    "extended_spot": "BTCSPOT-USD",
    "hibachi": "BTC/USDT-P",
}


def feed_rows(venues: Sequence[str] = schemas.VENUES, symbols: dict[str, str] | None = None) -> list[tuple]:
    """Feeds of the venues in order; a venue named twice gives its feeds twice."""
    if not venues:
        raise ValueError("at least one venue is required")
    unknown = [venue for venue in venues if venue not in schemas.VENUES]
    if unknown:
        raise ValueError(f"unknown venues: {', '.join(unknown)}")
    names = {**DEFAULT_SYMBOLS, **(symbols or {})}
    for key, symbol in names.items():
        if not symbol:
            raise ValueError(f"{key} symbol cannot be empty")

    def plain(venue: str, symbol: str, channels: Sequence[str], topics=None) -> list[tuple]:
        return [(venue, venue, symbol, c, f"{venue}-{symbol}-{c}", topics) for c in channels]

    catalogue = {
        "bitfinex": plain("bitfinex", names["bitfinex"], HISTORY_CHANNELS),
        "extended": plain("extended", names["extended"], PERPETUAL_CHANNELS)
        + plain("extended", names["extended_spot"], SPOT_CHANNELS),
        "hibachi": plain("hibachi", names["hibachi"], ("market_data",), list(SHARED_TOPICS)),
        "deribit": [
            ("deribit", "deribit", "BTC", "instrument_lifecycle", "deribit-BTC-instruments", None)
        ],
        "hyperliquid": [
            ("hyperliquid", "hyperliquid", "spot_btc", "spot_market_data", "hyperliquid-spot-btc", None)
        ],
    }
    return [row for venue in venues for row in catalogue[venue]]


def feed_catalogue(
    spark: SparkSession,
    venues: Sequence[str] = schemas.VENUES,
    symbols: dict[str, str] | None = None,
) -> DataFrame:
    return spark.createDataFrame(feed_rows(venues, symbols), FEED_COLUMNS)


def feed_coverage(feeds: DataFrame, seen: DataFrame) -> DataFrame:
    """Expected feeds next to what was captured: `messages` per feed, 0 when none was seen.

    `seen` is reduced to one row per feed before the join, so only counts travel.
    """
    counted = seen.groupBy("exchange", "symbol", "channel").agg(F.count(F.lit(1)).alias("messages"))
    return feeds.join(counted, ["exchange", "symbol", "channel"], "left").withColumn(
        "messages", F.coalesce("messages", F.lit(0))
    )


def select_venues(events: DataFrame, venues: Sequence[str]) -> DataFrame:
    return events.where(F.col("exchange").isin(*venues))
