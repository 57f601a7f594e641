import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from tapeloom.llm import lm_scoring
from tapeloom.llm.blobs import pack_planes, pack_sorted, unpack_planes, unpack_sorted
from tapeloom.llm.queries import fold


def test_blobs_round_trip():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64))
    assert (unpack_sorted(pack_sorted(values)) == values).all()
    assert (unpack_planes(pack_planes(values[:0]), np.uint64) == values[:0]).all()


@pytest.mark.parametrize(("order", "block_bytes"), [(1, 1 << 20), (2, 5_000), (3, 5_000)])
def test_scores_equal_plain_recursion(spark, monkeypatch, order, block_bytes):
    rows = [r for r in cases.edge_rows() if r[0] is not None and r[0] != 106]
    docs = spark.createDataFrame(rows, cases.DOCS)
    scored = lm_scoring.score_texts(
        docs, fold("doc_id", 7) == 2, order=order, prior=4.0, block_bytes=block_bytes
    ).collect()
    held = {r.doc_id: r.held_out for r in scored}
    assert len(scored) == len(rows) and any(held.values())
    expected = cases.backoff_scores([r[1] for r in rows], [not held[r[0]] for r in rows], order, 4.0)
    by_row = {(r[0], r[1]): e for r, e in zip(rows, expected, strict=True)}
    by_id = {i: {round(e, 6) for (j, _), e in by_row.items() if j == i} for i in held}
    for r in scored:
        assert min(abs(r.score - e) for e in by_id[r.doc_id]) < 1e-6 * max(1, abs(r.score))
        assert r.n_known <= r.n_tokens and r.base_score < 0
    tokens = sum(len(cases.words(r[1])) + 1 for r in rows if not held[r[0]])
    assert {r.train_tokens for r in scored} == {tokens}
    sizes = sorted(len(cases.words(r[1])) + 1 for r in rows)
    assert sorted(r.n_tokens for r in scored) == sizes


def test_order_one_is_the_base_score(spark):
    scored = lm_scoring.score_texts(cases.edge_docs(spark), fold("doc_id", 7) == 2, order=1).collect()
    assert all(abs(r.score - r.base_score) < 1e-6 * abs(r.base_score) for r in scored)


def test_nothing_to_learn_and_empty_table(spark):
    docs = cases.with_clashing_columns(cases.edge_docs(spark))
    untrained = lm_scoring.score_texts(docs, F.lit(True)).collect()
    assert len(untrained) == len(cases.edge_rows()) and {r.train_tokens for r in untrained} == {0}
    assert all(r.score == 0 for r in untrained)
    assert lm_scoring.score_texts(cases.empty_docs(spark), F.lit(False)).count() == 0


@pytest.mark.parametrize("fanout", [2, 3])
def test_levels_of_the_exchange_change_no_score(spark, fanout):
    docs = cases.edge_docs(spark).filter("doc_id not in (105, 106)")
    held = fold("doc_id", 7) == 2
    rows = lambda frame: sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in frame.collect())  # noqa: E731, E501
    flat = rows(lm_scoring.score_texts(docs, held, prior=4.0, block_bytes=1 << 20))
    assert len(lm_scoring.exchange_ways(lm_scoring.text_blocks(docs, 300), fanout)) >= 2
    assert rows(lm_scoring.score_texts(docs, held, prior=4.0, block_bytes=300, fanout=fanout)) == flat


def test_messages_grow_with_the_blocks():
    for blocks in (1, 100, 256, 257, 5_000, 4_000_000, 13_000_000):
        ways = lm_scoring.exchange_ways(blocks, 256)
        assert max(ways) <= 256 and np.prod([float(w) for w in ways]) >= blocks
        senders, parts, sent = blocks, 1, 0
        for w in ways:
            sent += senders * parts * w
            senders, parts = -(-senders // 256), parts * w
        assert senders == 1 and sent <= 256 * blocks * len(ways) * 2


def test_hot_rows_reach_a_block_as_few(spark):
    docs = spark.range(6000).selectExpr("IF(id % 3 = 0, id, NULL) AS doc_id", "IF(id % 3 = 0, 'a b c', IF(id % 3 = 1, 'x y', NULL)) AS text")
    scored = lm_scoring.score_texts(docs.repartition(4), F.lit(False), order=2).groupBy("doc_id", "n_tokens", "train_tokens", "n_known").count()
    rows = {(r.doc_id, r.n_tokens): r for r in scored.collect()}
    assert len(rows) == 2002 and rows[None, 3]["count"] == rows[None, 1]["count"] == 2000
    assert {r.train_tokens for r in rows.values()} == {2000 * (4 + 3 + 1)} and all(r.n_known == r.n_tokens for r in rows.values())
    batch = docs.selectExpr("doc_id", "false AS held_out", "coalesce(text, '') AS text").toArrow().to_batches()
    assert sum(len(b) for b in lm_scoring._combine(batch)) == 2002
