"""Exact limits that hold for hot groups: no group is ever ranked inside one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapeloom.session import materialize

# Largest limit whose rows one task may sort; more rows are numbered after a range sort.
TOP_K_ROWS = 100_000
# Up to this limit parts of the rows are cut down in two steps, without a second look at the data.
TREE_ROWS, TREE_PARTS = 1_000, 256
# Beyond it a quantile sketch bounds the rows first: so many times the limit may meet in one task.
BOUND_SLACK = 4
# The same per group; up to this size Spark applies the limit before its shuffle.
GROUP_TOP_K_ROWS = 1_000
GROUP_SALTS = 64


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "row_number") -> DataFrame:
    """Number the rows of each group `by` from 1 in `order`, spreading large groups over tasks.

    Rows are range-sorted and stored once. Within a stored partition the rows of a group are
    contiguous, so a row's number is its place in the partition plus the rows of its group in
    earlier partitions; only those per-partition counts are combined.
    """
    spark = df.sparkSession
    sort = [*by, *order]
    # The tie breaker lets equal rows, however many, fall into several ranges.
    ranged = df.withColumn("tie", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*sort, "tie").sortWithinPartitions(*sort, "tie")
    placed = ranged.drop("tie").withColumns(
        {"part_no": F.spark_partition_id(), "place": F.monotonically_increasing_id()}
    )
    stored = materialize(spark, placed, "ranked")
    keys = ["part_no", *by]
    counts = stored.groupBy(*keys).agg(
        F.min("place").alias("first_place"), F.count(F.lit(1)).alias("rows_here")
    )
    groups = [F.col(key) for key in by] or [F.lit(0)]
    earlier = (
        Window.partitionBy(*groups).orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        *[F.col(key).alias(f"{key}_of_part") for key in keys],
        "first_place",
        F.coalesce(F.sum("rows_here").over(earlier), F.lit(0)).alias("offset"),
    )
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"{key}_of_part"))
    number = F.col("offset") + F.col("place") - F.col("first_place") + 1
    return stored.join(offsets, condition).select(*df.columns, number.cast("bigint").alias(name))


def first_rows(
    df: DataFrame, order: Sequence[str], limit: int, top_k_rows: int = TOP_K_ROWS, descending: bool = False
) -> DataFrame:
    """The first `limit` rows in `order`, exactly, or the last with `descending`; the result is not itself ordered.

    No task receives `limit` rows of every partition. A small limit is cut down in two steps; a larger one reads only
    the rows up to a bound that quantile sketches give, and that counts confirm; above `top_k_rows` the rows are numbered.
    Give stored rows for a large limit, since the sketches read them too.
    """
    if limit <= 0:
        raise ValueError("limit must be greater than zero")
    if limit > top_k_rows and not descending:
        return row_numbers(df, [], order).where(F.col("row_number") <= limit).drop("row_number")
    if limit <= TREE_ROWS:
        return _tree_top(df, order, limit, descending)
    return _bounded_top(df, order, limit, descending)


def _sorted_by(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.desc(name) if descending else F.asc(name) for name in order]


def _tree_top(df: DataFrame, order: Sequence[str], limit: int, descending: bool) -> DataFrame:
    """Top rows of parts of the partitions, then of all: Spark applies both limits before it moves rows."""
    ranked = Window.partitionBy("part").orderBy(*_sorted_by(order, descending))
    parts = (
        df.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(TREE_PARTS)))
        .withColumn("place", F.row_number().over(ranked))
        .where(F.col("place") <= limit)
        .drop("part", "place")
    )
    return parts.orderBy(*_sorted_by(order, descending)).limit(limit)


def _bounded_top(df: DataFrame, order: Sequence[str], limit: int, descending: bool) -> DataFrame:
    """The first rows among those up to a bound of the first column, which must be a number without nulls.

    Sketches of the rows up to the last bound give a nearer one, while more than `BOUND_SLACK` times the limit are
    left. Where equal values alone exceed that, the rows ahead of them all belong to the result, and the next column
    decides among the equal ones.
    """
    name = order[0]
    shares = [2.0**-i for i in range(33)]
    grid = [1 - share if descending else share for share in shares]

    def ahead(bound, also_equal: bool) -> Column:
        column = F.col(name)
        if descending:
            return column >= bound if also_equal else column > bound
        return column <= bound if also_equal else column < bound

    def look(rows: DataFrame) -> tuple[int, list]:
        seen = rows.agg(F.count(F.lit(1)).alias("rows"), F.percentile_approx(name, grid, 10_000).alias("bounds")).first()
        return seen["rows"], seen["bounds"]

    within = df
    rows, bounds = look(within)
    while rows > BOUND_SLACK * limit:
        # The smallest share that holds enough rows; sketches err, so the counts decide.
        for share, bound in sorted(zip(shares, bounds, strict=True)):
            if share * rows < limit:
                continue
            found = within.agg(
                F.count_if(ahead(bound, True)).alias("upto"), F.count_if(ahead(bound, False)).alias("before")
            ).first()
            if found["upto"] >= limit:
                break
        if found["upto"] <= BOUND_SLACK * limit:
            within = within.where(ahead(bound, True))
            break
        if found["before"] < limit:
            first, equal = within.where(ahead(bound, False)), within.where(F.col(name) == bound)
            left = limit - found["before"]
            others = list(order[1:])
            return first.unionByName(first_rows(equal, others, left, descending=descending) if others else equal.limit(left))
        within = within.where(ahead(bound, False))
        rows, bounds = look(within)
    return within.orderBy(*_sorted_by(order, descending)).limit(limit)


def first_rows_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[str], limit: int, top_k_rows: int = GROUP_TOP_K_ROWS
) -> DataFrame:
    """The first `limit` rows of each group, exactly.

    A small limit is taken within salted parts of each group first: Spark cuts every group down
    to the limit in each task before the shuffle, and a group that holds most of the rows is cut
    down again in many tasks before its survivors meet in one.
    """
    if limit <= 0:
        raise ValueError("limit must be greater than zero")
    if limit > top_k_rows:
        return row_numbers(df, by, order).where(F.col("row_number") <= limit).drop("row_number")
    parts = Window.partitionBy(*by, "salt").orderBy(*order)
    groups = Window.partitionBy(*by).orderBy(*order)
    return (
        df.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(GROUP_SALTS)))
        .withColumn("row_number", F.row_number().over(parts))
        .where(F.col("row_number") <= limit)
        .drop("salt", "row_number")
        .withColumn("row_number", F.row_number().over(groups))
        .where(F.col("row_number") <= limit)
        .drop("row_number")
    )
