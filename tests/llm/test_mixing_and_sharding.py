import collections
import zlib

import pytest
from pyspark.sql import functions as F

import cases
from tapeloom.llm import mixing, sharding


def targets(sizes):
    """Shares by weight, the excess over three times the size dealt again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        level = left / free if free else 0
        over = {s for s in order if s not in capped and weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


@pytest.fixture(scope="module")
def uneven(spark):
    rows = []
    for i in range(900):
        source = ["big", "mid", None, "zero", "tiny"][0 if i % 3 == 0 else i % 5]
        words = 0 if source == "zero" else 1 + i * 7 % (5 if source == "tiny" else 90)
        rows.append((i, " ".join(["x"] * words), "en", source, 0))
    return spark.createDataFrame(rows, cases.DOCS)


def test_taken_words_meet_the_targets(spark, uneven):
    rows = mixing.mix_plan(spark, uneven, shards=5, block_words=64, buckets=4).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += len(cases.words(r.text))
    expected = targets(sizes)
    taken, at = collections.Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        at[r.source] = r.target
        assert r.size == len(cases.words(r.text)) and r.source_size == sizes[r.source]
        assert r.taken == sum(p.words for p in r.placements) <= 3 * r.size
        assert len({p["copy"] for p in r.placements}) == len(r.placements) <= 3
    for source, target in expected.items():
        assert at[source] == pytest.approx(target) and abs(taken[source] - target) <= 0.5
    assert any(t == 3 * sizes[s] > 0 for s, t in expected.items())


def test_reruns_agree_and_shards_are_even(spark, uneven):
    plan = mixing.mix_plan(spark, uneven, shards=4, block_words=16, buckets=8)
    again = mixing.mix_plan(spark, uneven.repartition(7), shards=4, block_words=16, buckets=8)
    placed = lambda p: {r.doc_id: r.placements for r in p.collect()}
    assert placed(plan) == placed(again)
    mixed = mixing.local_order(spark, mixing.mixed_documents(plan), buckets=3).collect()
    words = collections.Counter()
    for r in mixed:
        words[r.shard] += r.words
        assert len(cases.words(r.text)) == r.words
    assert set(words) == {0, 1, 2, 3} and max(words.values()) < 1.1 * min(words.values())
    for shard in words:
        assert sorted(r.slot for r in mixed if r.shard == shard) == list(range(sum(r.shard == shard for r in mixed)))


def test_tree_keeps_quotas_and_draws_like_an_urn(spark):
    root = spark.createDataFrame([([40, 0, 7, 1],)], "quotas array<bigint>")
    sums = collections.Counter()
    for seed in range(40):
        leaves = mixing.split_quotas(root, 3, seed).collect()
        assert sorted(r.shard for r in leaves) == [0, 1, 2]
        assert [sum(x) for x in zip(*(r.quotas for r in leaves), strict=True)] == [40, 0, 7, 1]
        assert all(15 <= sum(r.quotas) <= 17 for r in leaves)
        sums.update({r.shard: r.quotas[0] for r in leaves})
    assert all(abs(sums[s] / 40 - 40 / 3) < 0.8 for s in range(3))


def test_placements_are_shuffled_in_their_shard(spark, uneven):
    plan = mixing.mix_plan(spark, uneven, shards=4, block_words=16, buckets=8)
    rows = mixing.placed_in_order(spark, plan, buckets=3).collect()
    again = mixing.placed_in_order(spark, mixing.mix_plan(spark, uneven.repartition(5), shards=4, block_words=16, buckets=8)).collect()
    assert len(rows) == uneven.count() and len({r.doc_id for r in rows}) == len(rows)
    assert {r.doc_id: len(r.placements) for r in rows} == {r.doc_id: len(r.placements) for r in again}
    plain = {r.doc_id: r.placements for r in plan.collect()}
    slots = collections.defaultdict(list)
    for r in rows:
        assert [(p["copy"], p.words, p.shard) for p in r.placements] == [(p["copy"], p.words, p.shard) for p in plain[r.doc_id]]
        for p in r.placements:
            slots[p.shard].append((p.slot, r.source or "", r.stream_start))
    for held in slots.values():
        assert sorted(slot for slot, _, _ in held) == list(range(len(held)))
        order = [(source, start) for _, source, start in sorted(held)]
        assert order != sorted(order)  # not the order of the streams
    for docs in (cases.with_clashing_columns(cases.edge_docs(spark)), cases.empty_docs(spark)):
        placed = mixing.placed_in_order(spark, mixing.mix_plan(spark, docs))
        assert placed.count() == docs.count()
        assert all((r.taken > 0) == bool(r.placements) for r in placed.collect())


def test_placed_in_order_runs_no_python(spark, uneven):
    placed = mixing.placed_in_order(spark, mixing.mix_plan(spark, uneven))
    assert "Python" not in placed._jdf.queryExecution().executedPlan().toString()


def test_mix_of_edge_rows(spark):
    docs = cases.with_clashing_columns(cases.edge_docs(spark))
    plan = mixing.mix_plan(spark, docs)
    assert plan.count() == len(cases.edge_rows())
    assert {r.taken for r in plan.filter("text is null or trim(text) = ''").collect()} == {0}
    mixed = mixing.mixed_documents(plan)
    assert mixed.count() > 0 and len(set(mixed.columns)) == len(mixed.columns)
    assert mixing.mix_plan(spark, cases.empty_docs(spark)).count() == 0


def test_mix_plan_runs_no_python(spark, uneven):
    plan = mixing.mixed_documents(mixing.mix_plan(spark, uneven))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", [False, True])
def test_shards_are_gapless_even_and_keep_copies_together(spark, hot):
    rows = [(i, f"text {i // 3} " * (1 + i % 3 * 0 + i // 3 % 40), "en", "s", 0) for i in range(3000)]
    if hot:
        rows += [(10_000 + i, "the same " * 20, "en", "s", 0) for i in range(1500)]
    docs = spark.createDataFrame(rows, cases.DOCS)
    got = sharding.shard_documents(docs, shards=8, range_rows=200).collect()
    sizes, slots, of_text = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in got:
        assert r.size == len(r.text.encode()) + 1
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        of_text[r.text].add(r.shard)
    assert len(got) == len(rows) and set(sizes) == set(range(8))
    assert max(sizes.values()) < 1.06 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(shards) == 1 for text, shards in of_text.items() if not text.startswith("the same"))
    again = sharding.shard_documents(docs.repartition(5), shards=8, range_rows=200).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in got} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_shards_of_edge_rows(spark):
    docs = cases.with_clashing_columns(cases.edge_docs(spark))
    got = sharding.shard_documents(docs, shards=3).withColumn("crc", F.crc32("text")).collect()
    assert len(got) == len(cases.edge_rows())
    assert {r.size for r in got if not r.text} == {1}
    assert all(r.crc == zlib.crc32(r.text.encode()) for r in got if r.text is not None)
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert sharding.shard_documents(cases.empty_docs(spark)).count() == 0


def test_ranges_are_balanced_by_rows_as_by_bytes(spark):
    rows = [(i, None if i % 3 == 0 else "" if i % 3 == 1 else f"text {i} " * 50, "en", "s", 0) for i in range(6000)]
    docs = spark.createDataFrame(rows, cases.DOCS)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.xxhash64(text).alias("cut_text"),
        F.xxhash64(F.lit(1), F.col("doc_id").cast("string")).alias("cut_doc"),
        ((F.octet_length(text) + 1) / docs.agg(F.sum(F.octet_length(text) + 1)).first()[0] / 2 + 1 / 12000).alias("cut_weight"),
    )
    splitters = sharding._splitters(keyed, 6000, 100, 32)
    counts = [r["count"] for r in keyed.groupBy(sharding._range_of(splitters)("cut_text", "cut_doc").alias("r")).count().collect()]
    assert sum(counts) == 6000 and max(counts) <= 4 * 6000 / 64
    got = sharding.shard_documents(docs, shards=8, range_rows=100).collect()
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == 6000 and all(sorted(s) == list(range(len(s))) for s in slots.values())
