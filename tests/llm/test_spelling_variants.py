import collections
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import cases
from tapeloom.llm import spelling_variants as spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    counts = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [o for o in words if abs(len(o) - len(w)) < 2 and one_edit(w, o)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def found(spark, rows):
    docs = spark.createDataFrame(rows, cases.DOCS).repartition(3)
    got = spelling.spelling_variants(spark, docs).collect()
    result = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    assert len(got) == len(result)
    return result


def misspelt(seed, words=60, texts=150):
    """Words over few letters, so that counts collide, with replaced, added and removed letters; chains of forms."""
    rng = random.Random(seed)
    letters = "abcdéçÿ×"
    stems = ["".join(rng.choice(letters) for _ in range(rng.choice([6, 7, 7, 8, 9, 12, 30]))) for _ in range(words)]
    rows = []
    for i in range(texts):
        text = []
        for stem in stems:
            for _ in range(rng.choice([1, 1, 3])):
                word = stem
                while rng.random() < 0.12:
                    at = rng.randrange(3)
                    edit = rng.choice(["", rng.choice("abé"), word[at] + rng.choice("ab")])
                    word = word[:at] + edit + word[at + 1 :]
                text.append(rng.choice([word, word.capitalize(), word.upper()]))
        rows.append((i, ", ".join(text), "en", "s", 0))
    return [*rows, (texts, "chainword " * 400 + "chainwore " * 30 + "chainxore " * 2, "en", "s", 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(spelling, "CELL_ROWS", 64)
    monkeypatch.setattr(spelling, "LEAST_SAMPLE", 8)
    monkeypatch.setattr(spelling, "LEAF", 3)
    rows = misspelt(seed)
    want = expected(rows)
    assert len(want) > 300 and any(v[1] not in (v[0], w) for w, v in want.items())
    assert found(spark, rows) == want


def test_words_of_equal_letter_counts_are_dealt_out(spark, monkeypatch):
    """All orders of seven letters have one vector: no cut parts them."""
    monkeypatch.setattr(spelling, "CELL_ROWS", 64)
    words = ["".join(p) for p in itertools.islice(itertools.permutations("abcdefg"), 0, 5040, 4)]
    words += [w[:3] + "z" + w[4:] for w in words[::9]] + [w + "q" for w in words[::7]]
    rows = [(i, " ".join(words), "en", "s", 0) for i in range(3)]
    assert found(spark, rows) == expected(rows)


def test_edge_rows(spark):
    long = "x" * 70_000
    more = [(300, f"{long} {long} {long}y {long}y {long}z", "en", "s", 1), (301, f"{long}z Ünïcødé ünïcødé Ünïcødé", "en", "s", 1)]
    rows = cases.edge_rows() + more
    got = found(spark, rows)
    assert got == expected(rows) and long in got
    docs = cases.with_clashing_columns(spark.createDataFrame(rows, cases.DOCS))
    assert spelling.spelling_variants(spark, docs).count() == len(got)
    assert spelling.spelling_variants(spark, cases.empty_docs(spark)).count() == 0


def test_boxes_reach_every_word_an_edit_away():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(400)]
    router = spelling.Router(words[::5], 50_000)
    assert router.used > 3
    edits = [w[:2] + rng.choice("abcdefgh") + w[3:] for w in words] + [w[:4] + "a" + w[4:] for w in words]
    rows, boxes, _, kinds = router.send(spelling.Words(pa.array(words + edits)))
    home = dict(zip(rows[kinds == 0].tolist(), boxes[kinds == 0].tolist(), strict=True))
    sent = set(zip(rows[kinds == 1].tolist(), boxes[kinds == 1].tolist(), strict=True))
    assert len(home) == 1200 and all((i, home[400 + i]) in sent and (i, home[800 + i]) in sent for i in range(400))
    assert np.bincount(rows[kinds == 1]).mean() < router.used
