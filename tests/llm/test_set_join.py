import itertools
import random

import numpy as np
import pytest

import cases
from tapeloom.llm import set_join


def linked(percent):
    def test(a, b):
        n = len(a & b)
        return bool(a and b) and 100 * n >= percent * (len(a) + len(b) - n)

    return test


def varied(seed, texts, copies, lengths, vocabulary=400):
    """Groups of near copies: chains of edits, appended and removed words, so that links are not transitive."""
    rng = random.Random(seed)
    rows = []
    for _ in range(texts):
        text = [f"t{rng.randrange(vocabulary)}" for _ in range(rng.choice(lengths))]
        for _ in range(copies):
            rows.append(" ".join(text))
            for _ in range(rng.choice([0, 1, 1, 2])):
                at = rng.choice([0, len(text) - 1, rng.randrange(len(text))])
                text[at : at + 1] = rng.choice([[], [f"e{rng.randrange(10**6)}"], [text[at], f"e{rng.randrange(9)}"]])
                text = text or ["again"]
    rng.shuffle(rows)
    return [(i, t, "en", "s", 0) for i, t in enumerate(rows)]


def found(spark, rows, size, percent):
    docs = spark.createDataFrame(rows, cases.DOCS).repartition(3)
    got = set_join.similar_sets(spark, docs, shingle_words=size, percent=percent).collect()
    assert {r.doc_id: r.n_shingles for r in got} == {r[0]: len(cases.shingles(r[1], size)) for r in rows}
    return {r.doc_id: r.component_id for r in got}


def brute(rows, size, percent):
    return cases.components({r[0]: cases.shingles(r[1], size) for r in rows}, linked(percent))


@pytest.mark.parametrize(("size", "percent", "lengths"), [(3, 90, range(3, 45)), (3, 90, [60, 150]), (5, 80, range(6, 90))])
def test_components_equal_brute_force(spark, size, percent, lengths):
    rows = varied(size + percent, 25, 10, lengths)
    want = brute(rows, size, percent)
    assert len(set(want.values())) < len(rows) * 0.8
    assert found(spark, rows, size, percent) == want


@pytest.mark.parametrize("most", [0, 47])
def test_the_boundary_only_decides_the_way(spark, monkeypatch, most):
    monkeypatch.setattr(set_join, "boundary", lambda *_: most)
    rows = varied(most, 25, 10, range(3, 30))
    assert found(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_common_passages_and_long_lists(spark, monkeypatch):
    """Every text shares most of a passage; with few rows a block, lists are many blocks."""
    monkeypatch.setattr(set_join, "BLOCK_ROWS", 7)
    monkeypatch.setattr(set_join, "HOT_LEAST", 10**9)
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(90)]
    rows = []
    for i in range(90):
        own = [f"o{i % 30}x{k}" for k in range(rng.choice([5, 8, 11, 14]))]
        rows.append((i, " ".join(passage + own), "en", "s", 0))
    assert found(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_frequent_elements_rank_last(spark):
    rows = [(i, f"the common opening words of all texts {i} own{i} words{i} here{i}", "en", "s", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, cases.DOCS).repartition(2)
    tokens, counts = set_join.frequent_elements(docs, 3)
    assert len(tokens) == 5 and set(counts) == {300} and (np.diff(tokens.astype(object)) > 0).all()
    assert found(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_subsets_meet_exactly_at_the_threshold():
    rng = random.Random(4)
    with np.errstate(over="ignore"):
        for s, t in itertools.product(range(1, 15), repeat=2):
            for common in range(max(0, min(s, t) - 3), min(s, t) + 1):
                pool = np.array(rng.sample(range(10**9), s + t), dtype=np.uint64)
                a, b = pool[:s], np.concatenate([pool[:common], pool[s : s + t - common]])
                keys = [set(zip(*map(np.ndarray.tolist, set_join.subset_keys(x, {s, t}, 90)), strict=True)) for x in (a, b)]
                met = {k for k, _ in keys[0]} & {k for k, _ in keys[1]}
                assert bool(met) == (100 * common >= 90 * (s + t - common))


def test_boundary_is_where_the_cost_is_least():
    histogram = {5: 100, 12: 100, 20: 100, 40: 100}
    dear, cheap = {s: 10**6 for s in histogram}, {s: 1 for s in histogram}
    assert set_join.boundary(histogram, dear, 90) == 40
    assert set_join.boundary(histogram, cheap, 90) == 0
    assert set_join.boundary(histogram, {12: 10**5, 40: 10}, 90) == 12
    assert set_join.boundary({}, {}, 90) == 0


def test_edge_rows(spark):
    docs = cases.with_clashing_columns(cases.edge_docs(spark))
    got = set_join.similar_sets(spark, docs, shingle_words=3, percent=90).collect()
    assert len(got) == len(cases.edge_rows())
    assert all(r.component_id is None for r in got if r.doc_id is None)
    named = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [named[i].n_shingles for i in (100, 101, 102, 103, 104)] == [0, 0, 0, 1, 1]
    assert all(named[i].component_id == i for i in (100, 101, 102, 103, 104))
    assert named[106].component_id == 105
    assert set_join.similar_sets(spark, cases.empty_docs(spark)).count() == 0
