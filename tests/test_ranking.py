import random
import re

from pyspark.sql import functions as F

from tapeloom.operators import ranking
from tapeloom.operators.ranking import first_rows, first_rows_per_group, row_numbers


def skewed(spark):
    """One group holds most rows, and a third of all rows are copies of one row."""
    rng = random.Random(3)
    rows = [("hot", rng.randrange(50), n) for n in range(600)] + [("hot", 7, -1)] * 400
    rows += [(f"g{n % 7}", n, n) for n in range(200)]
    return rows, spark.createDataFrame(rows, "g string, k int, v int").repartition(5)


def test_row_numbers_are_exact_under_skew(spark):
    rows, df = skewed(spark)
    got = [tuple(r) for r in row_numbers(df, ["g"], ["k", "v"]).collect()]
    expected = []
    for group in {r[0] for r in rows}:
        ordered = sorted(r for r in rows if r[0] == group)
        expected += [(*row, n + 1) for n, row in enumerate(ordered)]
    assert sorted(got) == sorted(expected)
    # The hot group is numbered in several tasks.
    got = sorted(tuple(r) for r in row_numbers(df, [], ["k", "v"], "n").select("k", "v", "n").collect())
    assert sorted(n for *_, n in got) == list(range(1, len(rows) + 1))


def test_first_rows_both_ways(spark):
    rows, df = skewed(spark)
    expected = sorted((k, v) for _, k, v in rows)[:500]
    for top_k in (1_000, 10):
        assert sorted((r["k"], r["v"]) for r in first_rows(df, ["k", "v"], 500, top_k).collect()) == expected


def test_first_rows_per_group_both_ways(spark):
    rows, df = skewed(spark)
    expected = []
    for group in {r[0] for r in rows}:
        expected += sorted(r for r in rows if r[0] == group)[:30]
    for top_k in (1_000, 10):
        got = first_rows_per_group(df, ["g"], ["k", "v"], 30, top_k)
        assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def test_small_limit_is_applied_before_the_shuffle(spark, capsys):
    _, df = skewed(spark)
    first_rows_per_group(df, ["g"], ["k", "v"], 30).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_limits_in_two_steps_and_by_sketches(spark, monkeypatch):
    """A third of the rows are copies of one row and one value of `k` holds most rows: ties are exact, in both directions."""
    rows, df = skewed(spark)
    df = df.cache()
    ordered = sorted((k, v) for _, k, v in rows)
    for tree_rows, slack in ((10_000, 4), (0, 1), (0, 4)):
        monkeypatch.setattr(ranking, "TREE_ROWS", tree_rows)
        monkeypatch.setattr(ranking, "BOUND_SLACK", slack)
        for limit in (1, 60, 250, 1_150, 5_000):
            for descending, expected in ((False, ordered[:limit]), (True, ordered[-limit:])):
                got = first_rows(df, ["k", "v"], limit, descending=descending).collect()
                assert sorted((r["k"], r["v"]) for r in got) == expected, (tree_rows, slack, limit, descending)


def test_no_task_gets_the_limit_of_every_partition(spark, capsys):
    numbers = spark.range(0, 200_000, 1, 40).select(((F.col("id") * 7_919) % 200_003).alias("k"), "id")
    top = first_rows(numbers, ["k", "id"], 2_000)
    top.explain("extended")
    # The top-k sorts the rows up to the bound of the plan: a small multiple of the limit, not 40 times 2,000 rows.
    bound = int(re.search(r"<= (\d+)", capsys.readouterr().out).group(1))
    assert 2_000 <= numbers.where(F.col("k") <= bound).count() <= ranking.BOUND_SLACK * 2_000
    assert sorted(r["k"] for r in top.collect()) == sorted(r["k"] for r in numbers.orderBy("k").limit(2_000).collect())
    first_rows(numbers, ["k", "id"], 1_000).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out
