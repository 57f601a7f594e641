"""JSON scalars as columns: typed reads, text of scalars, message parts.

Payloads are parsed once with `from_json` into text fields, because that keeps the number form
(`60000.0`, `-0.0`). What that loses is whether a text was a JSON string or a number, which matters
only for a few rare texts; for those `scalar_text` takes the type of the field from the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# Texts that need a second look: containers, reals that Java prints with an exponent, and
# integers that may not fit 64 bits.
_RARE = r"^([\[{]|-?[0-9]\.[0-9]+E-?[0-9]+$|-?[0-9]{19,}$)"

# Canonical text of a JSON number as `from_json` gives it: integers of 64 bits and short reals as
# they are; reals with an exponent, and wider integers, in the shortest round-trip form, plain from
# 1e-5 up to 1e16 and with an exponent beyond. The mantissa has one digit before the point, so the
# exponent alone decides.
_PLAIN = "rtrim('0', cast(try_cast({text} AS decimal(38,21)) AS string))"
_NUMBER_TEXT = f"""
CASE WHEN instr({{text}}, 'E') > 0 THEN
       CASE WHEN cast(substring_index({{text}}, 'E', -1) AS int) BETWEEN -5 AND 15
            THEN concat({_PLAIN}, if(endswith({_PLAIN}, '.'), '0', ''))
            ELSE replace(replace({{text}}, '.0E', 'E'), 'E', 'e') END
     WHEN {{text}} RLIKE r'^-?[0-9]{{{{19,}}}}$'
          AND NOT coalesce(try_cast({{text}} AS decimal(38,0))
                           BETWEEN -9223372036854775808BD AND 18446744073709551615BD, false)
     THEN replace(replace(cast(cast({{text}} AS double) AS string), '.0E', 'E'), 'E', 'e')
     ELSE {{text}}
END"""

_SCALAR_TEXT = (
    "CASE WHEN {text} RLIKE r'" + _RARE + "' THEN CASE WHEN {type} = 'STRING' THEN {text}"
    " WHEN left({text}, 1) IN ('{{', '[') THEN NULL ELSE " + _NUMBER_TEXT + " END ELSE {text} END"
)
_SCALAR_TEXT = _SCALAR_TEXT.replace(_RARE, _RARE.replace("{", "{{").replace("}", "}}"))


def parse_json_column(df: DataFrame, text: str, schema: str, name: str) -> DataFrame:
    """Add `name` = the text parsed by schema.

    The value goes through a one-element generator, which filters are not pushed through: a
    filter on a parsed field would otherwise be copied below it and parse every row twice.
    """
    parsed = F.from_json(F.col(text), schema, JSON_OPTIONS)
    return add_once(df, parsed, name)


def add_once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a costly column that later filters must not evaluate a second time."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def string_only(value: Column) -> Column:
    """Text of a VARIANT that holds a JSON string; null for any other JSON type."""
    return F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))


# Types that a field must have in the document itself; `from_json` would raise and catch an error, with its stack, for
# each other value, which costs more than the parse. Read as VARIANT, such a value is only looked at.
EXACT_TYPES = ("bigint", "boolean")


def read_type(wanted: str) -> str:
    """The type by which `from_json` reads a field that is to be of type `wanted`."""
    return "variant" if wanted in EXACT_TYPES else wanted


def exact_only(value: Column, wanted: str) -> Column:
    """Value of a VARIANT that holds a 64-bit integer or a boolean; null for any other JSON type."""
    return F.when(F.schema_of_variant(value) == wanted.upper(), value.cast(wanted))


def number_text(text: str) -> Column:
    """Canonical text of a JSON number, given the name of a column with its text."""
    return F.expr(_NUMBER_TEXT.format(text=text))


def scalar_text(text: str, source: str, *paths: str) -> Column:
    """Text of a JSON scalar field; null for null, arrays and objects.

    `text` names a text field read by `from_json`, `source` the JSON document it was read from, and `paths` where
    the field stands in it: the first path that is there counts. The rule is one SQL expression, because
    dozens of fields of a row use it; only a rare text opens the document.
    """
    found = ", ".join(f"try_variant_get(try_parse_json({source}), '{path}', 'variant')" for path in paths)
    return F.expr(_SCALAR_TEXT.format(text=text, type=f"schema_of_variant(coalesce({found}))"))


def object_texts(source: Column, elements: Column, *paths: str) -> Column:
    """Array elements that are JSON objects, as texts.

    A JSON string whose content looks like an object would pass for one. Such a string shows as
    a quote followed by a brace in the source; only then are the element types looked up, in the
    first of `paths` that holds an array.
    """
    document = F.try_parse_json(source)
    typed = F.coalesce(
        *[F.try_variant_get(document, path, "array<variant>") for path in paths]
    )
    objects = F.filter(
        F.arrays_zip(elements.alias("text"), typed.alias("typed")),
        lambda pair: F.schema_of_variant(pair["typed"]).startswith("OBJECT"),
    )
    return F.when(
        source.contains('"{'), F.transform(objects, lambda pair: pair["text"])
    ).otherwise(elements)


_LAST = "end of the payload"


def is_json(source: Column) -> Column:
    """Whether the text is one JSON document and nothing else.

    Spark's parsers ignore what follows a document. In a list before a last element that is known, a document
    must be followed by that element.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), source, F.lit(f',"{_LAST}"]')))
    return F.coalesce(
        (F.try_variant_get(listed, "$[1]", "string") == _LAST)
        & F.try_variant_get(listed, "$[2]", "variant").isNull()
        & F.try_variant_get(listed, "$[0]", "variant").isNotNull(),
        F.lit(False),
    )


# Where the data of a message may stand, the first before the second.
DATA_PLACES = ("$.params.data", "$.data")

# Message parts ---------------------------------------------------------------------------------

# Envelope of every derivatives message. `data` and `result` are filled in by the reader.
_MESSAGE = (
    "jsonrpc: string, id: bigint, method: string, error: string,"
    " params: struct<channel: variant, type: variant, data: {data}>, data: {data}, result: {result}"
)


def message_schema(data: str = "string", result: str = "string") -> str:
    """DDL of a message whose `data` and `result` are read with the given types."""
    return _MESSAGE.format(data=data, result=result)


def parse_messages(
    df: DataFrame,
    data: str = "string",
    result: str = "string",
    payload: str = "payload_text",
    on_bad: str = "fail",
    where: Column | None = None,
) -> DataFrame:
    """Add `message`, the payload parsed once.

    The payload is read in a list before a last element that is known, so a document that is broken anywhere, and
    one that anything follows, is no message. on_bad: "fail" stops the job on a payload that is not JSON, naming
    `where` it came from; "keep" leaves such rows with a null message.
    """
    listed = F.concat(F.lit("["), F.col(payload), F.lit(f',{{"method":"{_LAST}"}}]'))
    messages = F.from_json(listed, f"array<struct<{message_schema(data, result)}>>", JSON_OPTIONS)
    parsed = add_once(df, messages, "messages").withColumn(
        "message",
        F.when(
            (F.size("messages") == 2) & (F.get("messages", F.lit(1))["method"] == _LAST), F.get("messages", F.lit(0))
        ),
    ).drop("messages")
    if on_bad == "keep":
        return parsed
    if on_bad != "fail":
        raise ValueError("on_bad must be 'fail' or 'keep'")
    place = F.lit("payload") if where is None else where
    error = F.raise_error(F.concat(F.lit("invalid JSON in "), place, F.lit(": "), F.col(payload)))
    return parsed.where(F.when(payload_is_json("message", payload), True).otherwise(error))


def payload_is_json(message: str = "message", payload: str = "payload_text") -> Column:
    """True when the payload is one JSON document. A parsed message proves it; only without one it is read again."""
    return F.when(F.col(message).isNotNull(), True).otherwise(is_json(F.col(payload)))


def message_data(message: str = "message", payload: str = "payload_text") -> Column:
    """`/params/data`, else top-level `data`.

    Whatever stands at `/params/data`, a null or an unexpected type too, keeps its place. The
    payload is looked at again only when the top-level field is the one left.
    """
    inner, outer = F.col(f"{message}.params.data"), F.col(f"{message}.data")
    inner_missing = F.try_variant_get(
        F.try_parse_json(F.col(payload)), "$.params.data", "variant"
    ).isNull()
    return F.when(inner.isNotNull(), inner).when(outer.isNotNull() & inner_missing, outer)


def message_channel(message: str = "message") -> Column:
    return string_only(F.col(f"{message}.params.channel"))


def response_id(message: str = "message") -> Column:
    """Unsigned integer `id` of a response."""
    number = F.col(f"{message}.id")
    return F.when(number >= 0, number)


def heartbeat_type(message: str = "message") -> Column:
    """`/params/type` of a heartbeat message, else null."""
    return F.when(
        F.col(f"{message}.method") == "heartbeat", string_only(F.col(f"{message}.params.type"))
    )


def error_text(message: str = "message") -> Column:
    """`error` member of a response, null when there is none."""
    return F.col(f"{message}.error")
