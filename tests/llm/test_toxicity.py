import random

import numpy as np
from pyspark.sql import functions as F

import cases
from tapeloom.llm import toxicity
from tapeloom.llm.boosting import BoostedTrees, Isotonic

LABELS = "doc_id bigint, quality int, toxic int, text string"


def corpus(count=1200):
    """Invented words; toxic texts hold words of a family that only they use, some of them new."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(count):
        text = [f"{rng.choice(['ba', 'do', 'ki', 'lu'])}{rng.randrange(300)}x".replace("0", "o").translate(str.maketrans("123456789", "abcdefghi")) for _ in range(60)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                word = "grumf" + "".join(rng.choice("abcdefgh") for _ in range(4))
                text[rng.randrange(60)] = rng.choice([word, word, "idiot"])
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, int(toxic), "x"))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + [(5000, None, "en", "s", 0), (5001, "", "en", "s", 0), (5002, cases.LONG, "en", "s", 0)], cases.DOCS)
    labels += [(None, 1, 1, "x"), (77_777, 1, 1, "x"), (3, 1, None, "x"), (4, 1, 9, "x"), (5, 1, 0, "x"), (5, 1, 0, "x")]
    known = spark.createDataFrame(labels, LABELS)
    model = toxicity.learn(spark, docs, known.filter(~toxicity.held_out()))
    got = toxicity.score_texts(cases.with_clashing_columns(docs), model).withColumn("held", toxicity.held_out()).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held and r.doc_id < 1200]
    assert len(held) > 150
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) >= 0.97 * len(held)
    assert all(r.predicted == 0 for r in got if r.doc_id >= 5000)


def test_without_labels_the_fixed_list_decides(spark):
    docs = spark.createDataFrame([(1, "you stupid IDIOT", "en", "s", 0), (2, "kind words", "en", "s", 0), (3, None, "en", "s", 0)], cases.DOCS)
    model = toxicity.learn(spark, docs, spark.createDataFrame([], LABELS))
    got = {r.doc_id: r.predicted for r in toxicity.score_texts(docs, model).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    assert toxicity.score_texts(cases.empty_docs(spark), model).count() == 0


def test_features_see_disguises_and_neighbours():
    import pyarrow as pa

    empty = toxicity.Lexicon(np.zeros(0, dtype=np.uint64), np.zeros(0))
    texts = ["you are an idiot", "an idiot is a word and nothing more than that while you", "1d10t", "i d i o t", "", None, "IDIOT!!!"]
    rows = toxicity._feature_rows(pa.array(texts), empty)
    assert rows.shape[0] == 7 and not rows[4].any() and not rows[5].any()
    near, disguised = 13, -3
    assert rows[0][near] > rows[1][near] == 0 or rows[0][near] > rows[1][near]
    assert rows[2][disguised] == 1 and rows[0][disguised] == 0


def test_trees_and_calibration():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    flipped = rng.random(3000) < 0.1
    y[flipped] = 1 - y[flipped]
    trees = BoostedTrees(rounds=40).fit(x[:2000], y[:2000], np.ones(2000))
    margins = trees.margins(x[2000:])
    assert ((margins > 0) == (y[2000:] > 0.5)).mean() > 0.85
    fit = Isotonic().fit(margins, y[2000:], np.ones(1000))
    p = fit.probabilities(np.sort(margins))
    assert (np.diff(p) >= 0).all() and abs(p.mean() - y[2000:].mean()) < 0.03
