"""Contract terms: instruments from list and creation messages, discovery, latest state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tapeloom import schemas
from tapeloom.functions.json_values import (
    DATA_PLACES,
    add_once,
    exact_only,
    message_channel,
    message_data,
    object_texts,
    parse_json_column,
    parse_messages,
    read_type,
    scalar_text,
    string_only,
)

_PAYLOAD_FIELDS = [f for f in schemas.INSTRUMENTS if f.name not in ("exchange", "symbol")]
_OBJECT_SCHEMA = ", ".join(
    f"`{f.name}` " + ("variant" if f.name == "instrument_name" else read_type(f.dataType.simpleString()))
    for f in _PAYLOAD_FIELDS
)
# Fields the discovery filters look at; each must be a JSON string to count.
_FILTER_SCHEMA = (
    "instrument_name variant, kind variant, base_currency variant, product_group variant,"
    " is_active variant"
)


def instrument_columns(item: str, source: str, *places: str) -> list[Column]:
    """The 19 instrument columns of a parsed object `item` that stands at `places` of the JSON text `source`."""
    columns = []
    for field in _PAYLOAD_FIELDS:
        path = f"{item}.{field.name}"
        if field.name == "instrument_name":
            value = string_only(F.col(path))
        elif field.dataType.simpleString() == "string":
            value = scalar_text(path, source, *[f"{place}.{field.name}" for place in places])
        else:
            value = exact_only(F.col(path), field.dataType.simpleString())
        columns.append(value.alias(field.name))
    return columns


def list_elements(events: DataFrame, keep: Sequence[str], on_bad: str = "fail") -> DataFrame:
    """One row per object in the `result` array of list responses: keep, pos, element (JSON text).

    Subscribe acknowledgements and other plain elements fall out. The payload, which may hold
    thousands of instruments, does not travel with the elements.
    """
    messages = parse_messages(events, result="array<string>", on_bad=on_bad)
    elements = object_texts(F.col("payload_text"), F.col("message.result"), "$.result")
    return messages.select(*keep, F.posexplode_outer(elements).alias("pos", "element")).where(
        F.col("element").startswith("{")
    )


def listed_instruments(
    events: DataFrame, order: Column | str = "line_no", keep: Sequence[str] = (), on_bad: str = "fail"
) -> DataFrame:
    """Instruments named in list responses, with their place in the load order."""
    ordered = events.withColumn("load_order", order if isinstance(order, Column) else F.col(order))
    items = list_elements(ordered, [*keep, "load_order"], on_bad)
    items = parse_json_column(items, "element", _OBJECT_SCHEMA, "item")
    return items.select(
        *keep,
        F.lit(0).alias("source_rank"),
        "load_order",
        "pos",
        *instrument_columns("item", "element", "$"),
    ).where("instrument_name is not null")


def created_instruments(
    events: DataFrame, order: Column | str = "line_no", keep: Sequence[str] = (), on_bad: str = "fail"
) -> DataFrame:
    """Instruments named in creation messages; they rank after all list responses."""
    ordered = events.withColumn("load_order", order if isinstance(order, Column) else F.col(order))
    messages = parse_messages(ordered, data=f"struct<{_OBJECT_SCHEMA.replace('` ', '`: ')}>", on_bad=on_bad)
    items = add_once(messages, message_data(), "item")
    return items.select(
        *keep,
        F.lit(1).alias("source_rank"),
        "load_order",
        F.lit(0).alias("pos"),
        *instrument_columns("item", "payload_text", *DATA_PLACES),
    ).where("instrument_name is not null")


def all_instruments(listed: DataFrame, created: DataFrame) -> DataFrame:
    return listed.unionByName(created)


def latest_instruments(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Last write wins per instrument: list responses in load order, then creation messages.

    `max_by` combines on the map side, so each task sends one row per instrument no matter how
    often an instrument is repeated.
    """
    payload = [name for name in schemas.INSTRUMENTS.names if name in rows.columns]
    terms = [name for name in payload if name != "instrument_name"]
    latest = rows.groupBy(*keep, "instrument_name").agg(
        F.max_by(F.struct(*terms), F.struct("source_rank", "load_order", "pos")).alias("latest")
    )
    return latest.select(
        *keep,
        F.lit(schemas.DERIVATIVES_EXCHANGE).alias("exchange"),
        F.lit(schemas.DERIVATIVES_SYMBOL).alias("symbol"),
        "instrument_name",
        *[F.col(f"latest.{name}").alias(name) for name in terms],
    )


def sorted_instruments(instruments: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return instruments.orderBy(*keep, "instrument_name")


# Discovery -------------------------------------------------------------------------------------


def _check_kinds(kinds: Sequence[str]) -> Sequence[str]:
    if not kinds:
        raise ValueError("at least one instrument kind is required")
    return kinds


def discovered_instruments(
    events: DataFrame, kinds: Sequence[str] = schemas.DERIVATIVES_KINDS, keep: Sequence[str] = ()
) -> DataFrame:
    """Active BTC instruments of the wanted kinds in list responses.

    BTC by base currency or product group; a missing `is_active` counts as active.
    """
    _check_kinds(kinds)
    items = parse_json_column(list_elements(events, keep, "keep"), "element", _FILTER_SCHEMA, "item")
    is_btc = F.coalesce(string_only(F.col("item.base_currency")) == "BTC", F.lit(False)) | F.coalesce(
        string_only(F.col("item.product_group")) == "BTC", F.lit(False)
    )
    return items.where(
        string_only(F.col("item.kind")).isin(*kinds)
        & is_btc
        & F.coalesce(exact_only(F.col("item.is_active"), "boolean"), F.lit(True))
    ).select(*keep, "pos", string_only(F.col("item.instrument_name")).alias("instrument_name")).where(
        "instrument_name is not null"
    )


def newly_created_instruments(
    events: DataFrame, kinds: Sequence[str] = schemas.DERIVATIVES_KINDS, keep: Sequence[str] = ()
) -> DataFrame:
    """BTC instruments announced on a creation channel.

    A missing currency or kind passes; a given one must be BTC or a wanted kind.
    """
    _check_kinds(kinds)
    data = f"struct<{_FILTER_SCHEMA.replace(' variant', ': variant')}>"
    items = add_once(parse_messages(events, data=data, on_bad="keep"), message_data(), "item")
    return items.where(
        message_channel().startswith("instrument.creation.")
        & F.coalesce(string_only(F.col("item.base_currency")) == "BTC", F.lit(True))
        & F.coalesce(string_only(F.col("item.kind")).isin(*kinds), F.lit(True))
    ).select(*keep, string_only(F.col("item.instrument_name")).alias("instrument_name")).where(
        "instrument_name is not null"
    )


def distinct_instruments(names: DataFrame) -> DataFrame:
    """Each instrument once; duplicates collapse before the shuffle."""
    return names.select("instrument_name").distinct()


def unknown_instruments(names: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct instruments that are not among the known ones.

    Both sides are reduced to distinct names first, so a name that fills the input is one row by
    the time it is joined.
    """
    return distinct_instruments(names).join(distinct_instruments(known), "instrument_name", "left_anti")
