"""Channel names: where a message is stored, and what is subscribed for an instrument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapeloom import schemas
from tapeloom.functions.json_values import JSON_OPTIONS, string_only

# Subscription prefix -> stored channel.
DERIVATIVES_ROUTES = {
    "instrument.creation.": "instrument_creation",
    "instrument.state.": "instrument_state",
    "incremental_ticker.": "incremental_ticker",
    "trades.": "trades",
}
# Message tag -> stored channel of the spot venue.
SPOT_ROUTES = {"trades": "trades", "l2Book": "book"}
CONTROL = "control"


def route_subscription(channel: Column) -> Column:
    """Stored channel of a subscription channel name; null or unknown names go to control."""
    routed = F.lit(CONTROL)
    for prefix, stored in reversed(DERIVATIVES_ROUTES.items()):
        routed = F.when(channel.startswith(prefix), stored).otherwise(routed)
    return routed


def _with_value(value: Column, rule) -> Column:
    """`rule` applied to a value it names several times; the value itself is computed once."""
    return F.get(F.transform(F.array(value), rule), F.lit(0))


def derivatives_output_channel(payload: Column) -> Column:
    """Stored channel of a derivatives message; text that is not JSON goes to control."""
    message = F.from_json(payload, "params struct<channel: variant>", JSON_OPTIONS)
    return _with_value(message["params"]["channel"], lambda c: route_subscription(string_only(c)))


def spot_output_channel(payload: Column) -> Column:
    """Stored channel of a spot-venue message, by its channel tag."""

    def route(tag: Column) -> Column:
        routed = F.lit(CONTROL)
        for name, stored in SPOT_ROUTES.items():
            routed = F.when(string_only(tag) == name, stored).otherwise(routed)
        return routed

    return _with_value(F.from_json(payload, "channel variant", JSON_OPTIONS)["channel"], route)


def output_channel(exchange: Column, feed_channel: Column, payload: Column) -> Column:
    """Stored channel by venue; the other venues keep the channel of their feed."""
    return (
        F.when(exchange == schemas.DERIVATIVES_EXCHANGE, derivatives_output_channel(payload))
        .when(exchange == "hyperliquid", spot_output_channel(payload))
        .otherwise(feed_channel)
    )


def lifecycle_channels(kind: Column) -> Column:
    """Two lifecycle channels per instrument kind, as an array."""
    return F.array(
        *[F.concat(F.lit(f"instrument.{what}."), kind, F.lit(".BTC")) for what in ("creation", "state")]
    )


def instrument_channels(
    instrument_name: Column, interval: str = schemas.DEFAULT_TRADES_INTERVAL
) -> Column:
    """Ticker and trades channel of an instrument, as an array."""
    check_trades_interval(interval)
    return F.array(
        F.concat(F.lit("incremental_ticker."), instrument_name),
        F.concat(F.lit("trades."), instrument_name, F.lit(f".{interval}")),
    )


def check_trades_interval(interval: str) -> str:
    if interval not in schemas.TRADES_INTERVALS:
        raise ValueError(f"trades interval must be one of: {', '.join(schemas.TRADES_INTERVALS)}")
    return interval


def pick_market(markets: DataFrame, base: str, quote: str, symbol: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Best market per group `by`: exact base and quote, else the symbol ignoring case, else a
    symbol that contains it; the first in list order (`position`) within a rank.

    Columns read: position, base, quote, symbol. Groups without a match give no row.
    """
    rank = (
        F.when((F.col("base") == base) & (F.col("quote") == quote), 0)
        .when(F.lower(F.regexp_replace("symbol", r"[^\x00-\x7F]", "?")) == symbol.lower(), 1)
        .when(F.col("symbol").contains(symbol), 2)
    )
    ranked = markets.withColumn("match_rank", rank).where("match_rank is not null")
    best = F.min_by(
        F.struct("match_rank", *markets.columns), F.struct("match_rank", "position")
    ).alias("best")
    return ranked.groupBy(*by).agg(best).where("best is not null").select("best.*")
