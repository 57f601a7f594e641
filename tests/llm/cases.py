"""Rows that every operator must take, and plain Python versions of what they compute."""

import collections
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names the operators use themselves.
CLASHING = "size int, shard string, score string, items int, target int, copy int, words int, row int, leaked int"

PROSE = [
    "the quick brown fox jumps over the lazy dog and then the dog sleeps by the old river until dawn",
    "a completely different sentence about markets and prices in the northern towns of the valley",
    "Numbers 12 and 3.5 stand here, with Names like Paris, and 40 km to go before the evening falls",
]


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def edge_rows():
    rows = [(i, PROSE[i % 3] + (f" extra{i}" if i % 4 == 0 else "")) for i in range(24)]
    rows += [(100, None), (101, ""), (102, " \t\n "), (103, "one"), (104, "é"), (None, PROSE[0]), (None, None)]
    rows += [(105, LONG), (106, LONG), (1, PROSE[1]), (200, "repeated row text here"), (200, "repeated row text here")]
    return [(i, t, "en", [None, "s1", "s2", "s3"][n % 4], len(t or "")) for n, (i, t) in enumerate(rows)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def with_clashing_columns(docs):
    from pyspark.sql import functions as F

    for column in CLASHING.split(", "):
        name, kind = column.split()
        docs = docs.withColumn(name, F.lit(7).cast(kind))
    return docs


def shingles(text, size):
    w = words(text)
    if len(w) >= size:
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    return {tuple(w)} if w else set()


def components(items, linked):
    """Smallest reachable id of each id."""
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(items)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if linked(items[a], items[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def backoff_scores(texts, training, order, prior):
    """n-gram scores by plain recursion: log10 probability of each text, its end included."""
    counts = collections.Counter()
    sequences = [["<s>", *words(t), "</s>"] for t in texts]
    for sequence, learn in zip(sequences, training, strict=True):
        for i in range(len(sequence)) if learn else ():
            for k in range(1, order + 1):
                if i - k + 1 >= 0:
                    counts[tuple(sequence[i - k + 1 : i + 1])] += 1
    single = {g: c for g, c in counts.items() if len(g) == 1 and g != ("<s>",)}
    total, types = sum(single.values()), len(single)

    def p(history, word):
        if not history:
            return (single.get((word,), 0) + 1) / (total + types + 1)
        context = counts[history]
        return (counts[(*history, word)] + prior * p(history[1:], word)) / (context + prior)

    return [
        sum(math.log10(p(tuple(s[max(0, i - order + 1) : i]), s[i])) for i in range(1, len(s))) for s in sequences
    ]
