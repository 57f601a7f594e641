import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeloom.llm import ann

VECTORS = "vec_id bigint, embedding array<float>, part int, block string"


def exact(rows, count):
    """True neighbours of each query: (id, score) by score, then id."""
    good = [
        (i, [float(np.float32(x)) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == len(rows[0][1])
    ]
    ids, matrix = np.array([i for i, _ in good]), np.array([v for _, v in good])
    result = {}
    for i, v in good:
        if i % 20 == 0:
            scores = ann.inner_products(np.tile(v, (len(good), 1)), matrix)
            order = sorted((-s, j) for s, j in zip(scores.tolist(), ids.tolist(), strict=True) if j != i)
            result[i] = [(j, -s) for s, j in order[:count]]
    return result


@pytest.mark.parametrize("blocks", [100_000, 150])
def test_neighbours_and_recall(spark, monkeypatch, blocks):
    monkeypatch.setattr(ann, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", blocks // 4)
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((30, 16))
    rows = [(i, (centers[i % 30] + 0.4 * rng.standard_normal(16)).tolist()) for i in range(2500)]
    rows += [(5000 + i, rows[17][1]) for i in range(60)]  # copies: ties
    rows += [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [math.nan] * 16), (9004, [None] * 16), (9005, [math.inf] + [0.0] * 15)]
    rows += [(9006, [1.0, 2.0]), (None, rows[0][1]), (40, rows[40][1])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS).repartition(3)
    got = ann.search(spark, frame, F.col("vec_id") % 20 == 0, count=20, check_queries=64).collect()
    true = exact(rows, 20)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == set(true)
    hits = 0
    for q, expected in true.items():
        ranked = sorted(found[q])
        assert [r for r, _, _ in ranked] == list(range(1, 21))
        assert all((-a[2], a[1]) <= (-b[2], b[1]) for a, b in zip(ranked, ranked[1:], strict=False))
        assert all(i != q for _, i, _ in ranked)
        hits += len({i for i, _ in expected} & {i for _, i, _ in ranked})
    assert hits >= 0.9 * sum(map(len, true.values()))


def test_few_rows_give_all_candidates_exactly(spark):
    rows = [(i, [1.0, i / 7, -1.0]) for i in range(25)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS)
    got = ann.search(spark, frame, F.col("vec_id") % 20 == 0, count=30).orderBy("query_id", "rank").collect()
    true = exact(rows, 30)
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(q, i, s) for q in (0, 20) for i, s in true[q]]
    assert ann.search(spark, frame.filter("vec_id < 1"), F.lit(True)).count() == 0
    assert ann.search(spark, frame.filter("vec_id < 0"), F.lit(True)).count() == 0


def test_parts_are_balanced():
    rng = np.random.default_rng(1)
    label = ann.balanced_parts(ann.sample_graph(rng.standard_normal((512, 8)), 8), 8)
    assert set(np.bincount(label)) == {64}


def test_parts_grow_with_the_rows_and_no_vector_is_copied(spark, monkeypatch):
    assert [ann.part_count(n) for n in (0, 10, 1_600_000, 1_600_001, 10**7, 10**12)] == [32, 32, 32, 64, 256, 1024]
    monkeypatch.setattr(ann, "BLOCK_ROWS", 40)
    rows = [(i, [1.0, i / 7, -1.0]) for i in range(300)]
    held, asked = [], []
    plain = ann.nearest

    def spy(query_ids, queries, ids, vectors, count):
        held.append(ids.tolist())
        asked.append(len(query_ids))
        return plain(query_ids, queries, ids, vectors, count)

    monkeypatch.setattr(ann, "nearest", spy)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 4)
    batch = lambda part, block, asks, some: ann.pa.RecordBatch.from_pydict(
        {"part": [part] * len(some), "block": [block] * len(some), "asks": [asks] * len(some),
         "vec_id": [i for i, _ in some], "embedding": [v for _, v in some]}
    )
    batches = [batch(0, 0, 0, rows[:30]), batch(0, 0, 0, rows[30:40]), batch(0, 0, 1, rows[::20]), batch(0, 1, 1, rows[:3]),
               batch(1, 0, 0, rows[40:80]), batch(2, 0, 0, rows[80:90]), batch(2, 0, 1, rows[:1])]
    joined = ann.pa.Table.from_batches(batches).combine_chunks().to_batches()
    for stream in (batches, joined):
        held.clear(), asked.clear()
        got = [r for b in ann._search(5)(iter(stream)) for r in b.to_pylist()]
        assert {tuple(h) for h in held} == {tuple(range(40)), tuple(range(80, 90))}
        assert max(asked) <= 4 and sum(asked) == 16
        assert len(got) == 16 * 5
