import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import cases
from tapeloom.llm import prefix_trie, queries

TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, keys string, words string, part int"


def said(rows):
    """Each conversation's turns in order, ties by digest."""
    convs = {}
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(conv_id, []).append((turn is not None, turn or 0, digest, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}


def exchanged(convs):
    result = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rest = abs(c) % 20 * (1 if c > 0 else -1)
        result[c] = convs.get(c - rest, [])[:h] + own[h:]
    return result


def expected(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    rows = {}
    for path in members:
        below = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in members[path] if len(convs[c]) == len(path))
        rows[min(members[path]), len(path)] = (
            min(members[path[:-1]]) if path else None,
            len(members[path]),
            len(children.get(path, [])),
            sum(p not in children for p in below),
            sum((len(members[p]) - 1) * len(cases.words(p[-1][1])) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return rows


def collected(frame):
    rows = frame.collect()
    got = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert [len(got)] == [len(rows)]
    return {k: (v[0], *v[1:]) for k, v in got.items()}


def talks(seed, convs):
    """Few distinct turns, so that prefixes are shared; copies, nulls, ties, repeated rows, one long conversation."""
    rng = random.Random(seed)
    rows = []
    for _ in range(convs):
        conv_id = rng.randrange(-60, 400)
        for _ in range(rng.choice([1, 2, 3, 6])):
            turn = rng.choice([None, 0, 1, 2, 3, 3])
            rows.append((conv_id, turn, rng.choice(["user", "assistant", None]), rng.choice(["a b", "a  b\tc", "", None]), 1, "k", "w", 2))
    rows += [(c, t, "user", f"hello {t}", 1, "k", "w", 2) for c in range(1000, 1090) for t in range(5)]
    rows += [(2000, t, "user", f"one of {t % 7}", 1, "k", "w", 2) for t in range(300)]
    rows += [(2020 + i, t, "user", f"one of {t % 7}", 1, "k", "w", 2) for i in range(3) for t in range(250 + i)]
    rows += [(None, 1, "user", "lost", 1, "k", "w", 2), (3000, 0, None, None, 1, "k", "w", 2), rows[0], rows[0]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [1, 3, 1024])
def test_equals_brute_force(spark, monkeypatch, size):
    """Tiny shards put most nodes on edges; few partitions put several shards into a task."""
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", size)
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 20)
    rows = talks(size, 150)
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    got = collected(prefix_trie.prefix_trie(spark, prefix_trie.sequences(turns)))
    assert got == expected(said(rows))


def test_a_long_conversation_may_fill_a_shard(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 40)
    rows = talks(5, 80)
    got = collected(prefix_trie.prefix_trie(spark, prefix_trie.sequences(spark.createDataFrame(rows, TURNS))))
    assert got == expected(said(rows))


def test_query_rebuilds_conversations(spark, tmp_path):
    rows = talks(7, 200) + [(20, 0, "user", "x", 1, "k", "w", 2), (21, 0, "user", "only turn", 1, "k", "w", 2)]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    frame = queries.op11_prefix_trie(spark, str(tmp_path))
    assert frame.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    convs = exchanged(said(rows))
    assert any(not turns for turns in convs.values())
    assert collected(frame) == expected(convs)


def test_empty_and_null_only(spark):
    for rows in ([], [(None, 0, "user", "x", 1, "k", "w", 2)]):
        turns = spark.createDataFrame(rows, TURNS)
        assert prefix_trie.prefix_trie(spark, prefix_trie.sequences(turns)).count() == 0


def test_very_long_texts_count_all_their_words(spark):
    rows = [(c, 0, "user", cases.LONG, 1, "k", "w", 2) for c in (1, 2)]
    got = collected(prefix_trie.prefix_trie(spark, prefix_trie.sequences(spark.createDataFrame(rows, TURNS))))
    assert got[1, 1][4] == 60_000 and got[1, 1] == expected(said(rows))[1, 1]


def test_donor_must_exist(spark):
    own = spark.createDataFrame([(5, [b"a"], [1])], "conv_id bigint, keys array<binary>, words array<int>")
    row = prefix_trie.rebuilt(own, F.lit(4).cast("long"), F.lit(3), 3).first()
    assert row.asDict() == {"conv_id": 5, "keys": [], "words": []}
