"""Resume points and limits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def resolve_start(requested: Column, checkpoint_next: Column) -> Column:
    """The later of the requested start and the checkpoint's next start; either alone; else null."""
    return F.greatest(requested, checkpoint_next)


def limit_remaining(maximum: Column, written: Column) -> Column:
    """How many rows may still be written; null maximum means no limit."""
    return F.greatest(F.when(maximum.isNotNull(), F.lit(0)), maximum - written)


def next_cursor(max_mts: Column, cursor: Column) -> Column:
    """Next page cursor; a cursor that does not advance fails."""
    following = max_mts + 1
    error = F.raise_error(F.concat(F.lit("the next page would not start behind "), cursor.cast("string")))
    return F.when(following <= cursor, error).otherwise(following)
