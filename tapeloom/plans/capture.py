"""Store received messages as routed envelopes, in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapeloom import schemas
from tapeloom.functions.routing import output_channel
from tapeloom.operators.ranking import first_rows_per_group
from tapeloom.sinks.events import append_events
from tapeloom.sources.raw_capture import build_envelopes


def route_messages(messages: DataFrame, received: Column | None = None) -> DataFrame:
    """Envelopes of received frames, each with the channel it is stored under.

    Columns read: exchange, symbol, channel (of the feed), connection_id, text and/or binary.
    Binary frames of the routed venues are stored as control messages.
    """
    text = F.col("text") if "text" in messages.columns else F.lit(None).cast("string")
    routed = messages.withColumn("channel", output_channel(F.col("exchange"), F.col("channel"), text))
    return build_envelopes(routed, received).select(*schemas.ENVELOPE.names)


def capture(
    messages: DataFrame,
    root: str,
    received: Column | None = None,
    max_messages: int | None = None,
    order: tuple[str, ...] = (),
    gather: bool = False,
) -> None:
    """Route and append. `max_messages` keeps the first messages of each feed in `order`;
    `gather` as in `append_events`."""
    if max_messages is not None:
        messages = first_rows_per_group(messages, ["exchange", "symbol", "channel"], list(order), max_messages)
    append_events(route_messages(messages, received), root, gather)
