import difflib
import os
import random

import numpy as np
import pytest

import cases
from tapeloom import session
from tapeloom.llm import decontamination, substring_dedup


def prose(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([[f"new{rng.randrange(10**6)}"], [], [words[at], "added"]])
    return words


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(8)
    rows, holders, short = [], {}, prose(rng, 30)
    passages = [prose(rng, 70) for _ in range(4)]
    for i in range(60):
        body = prose(rng, 120)
        kind = i % 6
        if kind < 3:
            at = rng.randrange(100)
            fuzzy = edited(rng, passages[i % 4], 3 if kind == 2 else 0)
            body[at:at] = fuzzy
            holders[i] = (at, at + len(fuzzy))
        elif kind == 3:
            body[5:5] = short  # repeated, but too short
        rows.append((i, " ".join(body), "en", "s", 0))
    docs = spark.createDataFrame(rows, cases.DOCS).repartition(4)
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(spark, docs).collect()}
    assert len(got) == 60
    for i, r in got.items():
        if i in holders:
            begin, end = holders[i]
            covered = sum(max(0, min(end, s.end) - max(begin, s.begin)) for s in r.spans)
            assert covered >= 0.7 * (end - begin) and r.repeated_words <= end - begin + 12, (i, r)
            assert r.n_links > 0 and r.partner_id in holders and r.partner_id != i
        else:
            assert not r.spans and r.n_links == 0 and r.partner_id is None


def test_chains_equal_a_quadratic_search():
    rng = np.random.default_rng(5)
    for _ in range(30):
        n = int(rng.integers(1, 25))
        x, y = rng.integers(0, 60, n), rng.integers(0, 60, n)
        best = {}
        for i in np.lexsort((-y, x)).tolist():
            before = [best[j] - substring_dedup.GAP_COST * float(x[i] + y[i] - x[j] - y[j]) for j in best if x[j] < x[i] and y[j] < y[i]]
            best[i] = substring_dedup.KMER + max([0.0, *before])
        found = substring_dedup.chains(x, y)
        assert sorted(np.concatenate(found).tolist()) == list(range(n))
        chain = found[0]
        assert (np.diff(x[chain]) > 0).all() and (np.diff(y[chain]) > 0).all()
        gaps = float((x[chain[-1]] - x[chain[0]]) + (y[chain[-1]] - y[chain[0]]))
        score = substring_dedup.KMER * len(chain) - substring_dedup.GAP_COST * gaps
        assert abs(score - max(best.values())) < 1e-9


def longest_part(runs, identity):
    """By trying all: words of the longest part that qualifies, gaps counted by their longer side."""
    best = 0
    for i in range(len(runs)):
        equal = foreign = 0
        for j in range(i, len(runs)):
            if j > i:
                foreign += max(runs[j][0] - runs[j - 1][0] - runs[j - 1][2], runs[j][1] - runs[j - 1][1] - runs[j - 1][2])
            equal += runs[j][2]
            if (1 - identity) * equal - identity * foreign >= -1e-9:
                best = max(best, substring_dedup.shortest(runs[i], runs[j]))
    return best


def test_the_longest_part_of_a_chain_is_found():
    rng = random.Random(11)
    for _ in range(300):
        runs, i, j = [], 0, 0
        for _ in range(rng.randrange(1, 12)):
            n = rng.randrange(1, 30)
            runs.append([i, j, n])
            i, j = i + n + rng.choice([0, 1, 2, 20]), j + n + rng.choice([1, 1, 3, 25])
        for identity in (0.5, 0.8, 0.95):
            begin, end = substring_dedup._longest(runs, 0, len(runs), identity)
            assert substring_dedup.shortest(runs[begin], runs[end - 1]) == longest_part(runs, identity)


def test_runs_are_equal_words_in_order():
    rng = random.Random(12)
    for _ in range(100):
        body = [rng.randrange(1, 40) for _ in range(rng.randrange(20, 200))]
        a = np.array(body, dtype=np.uint64)
        b = list(body)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(b))
            b[at : at + rng.randrange(3)] = [rng.randrange(50, 90) for _ in range(rng.choice([0, 1, 2, 70]))]
        b = np.array(b, dtype=np.uint64)
        at = {tuple(b[j : j + 5].tolist()): j for j in range(len(b) - 4)}
        matches = [(i, at[key]) for i in range(len(a) - 4) if (key := tuple(a[i : i + 5].tolist())) in at]
        if not matches:
            continue
        x, y = np.array(matches).T
        chain = substring_dedup.chains(x, y)[0]
        end_a = end_b = 0
        for i, j, n in substring_dedup.align(a, b, x[chain], y[chain]):
            assert n > 0 and i >= end_a and j >= end_b and (a[i : i + n] == b[j : j + n]).all()
            end_a, end_b = i + n, j + n


def test_foreign_words_between_passages_cost_neither(spark):
    rng = random.Random(13)
    between, rows = [0, 60, 100, 200, 300], []
    for k, n in enumerate(between):
        first, second = prose(rng, 150), prose(rng, 150)
        for side in (0, 1):
            middle = [f"between{rng.randrange(10**9)}" for _ in range(n + side * (n > 0))]
            rows.append((2 * k + side, " ".join([*first, *middle, *second]), "en", "s", 0))
    # A changed tail: a passage, then words of which too few are equal.
    shared, tail = prose(rng, 120), prose(rng, 120)
    for side in (0, 1):
        rows.append((100 + side, " ".join([*shared, *(w if i % 7 else f"own{side}x{i}" for i, w in enumerate(tail)), "end", str(side)]), "en", "s", 0))
    docs = spark.createDataFrame(rows, cases.DOCS).repartition(3)
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(spark, docs).collect()}
    for k, n in enumerate(between):
        for side in (0, 1):
            middle = n + side * (n > 0)
            expected = [(0, 150), (150 + middle, 300 + middle)] if n else [(0, 300)]
            assert [tuple(s) for s in got[2 * k + side].spans] == expected, (n, side, got[2 * k + side])
    for side in (0, 1):
        assert got[100 + side].spans[0].begin == 0 and got[100 + side].repeated_words >= 120


def test_holders_between_the_extreme_classes_are_linked(spark):
    """Each line is in 12 texts, each pair of lines, which makes a passage, in three; a word between them differs."""
    rng = random.Random(21)
    first, second = ([prose(rng, 30) for _ in range(4)] for _ in range(2))
    rows = []
    for k in range(16):
        for side in range(3):
            body = [*prose(rng, 60), *first[k // 4], f"own{k}x{side}", *second[k % 4], *prose(rng, 60)]
            rows.append((3 * k + side, " ".join(body), "en", "s", 0))
    docs = spark.createDataFrame(rows, cases.DOCS).repartition(3)
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(spark, docs).collect()}
    for i, r in got.items():
        assert [tuple(s) for s in r.spans] == [(60, 121)] and r.n_links == 2, r
        assert r.component_id == i // 3 * 3 and r.partner_id // 3 == i // 3, r


def test_every_link_is_in_a_component(spark):
    """Against all pairs: texts that share 50 equal words are of one component, members of a passage through it."""
    rng = random.Random(22)
    passages = [prose(rng, 60) for _ in range(10)]
    rows, texts = [], {}
    for i in range(60):
        body = prose(rng, 30)
        for passage in rng.sample(passages, rng.choice([0, 1, 1, 2])):
            body += [*passage[: rng.choice([50, 55, 60])], *prose(rng, 20)]
        texts[i] = body
        rows.append((i, " ".join(body), "en", "s", 0))
    grams = {i: {tuple(body[k : k + 50]) for k in range(len(body) - 49)} for i, body in texts.items()}
    linked = [{i, j} for i in grams for j in grams if i < j and grams[i] & grams[j]]
    expected = cases.components(grams, lambda a, b: a & b)
    docs = spark.createDataFrame(rows, cases.DOCS).repartition(3)
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(spark, docs).collect()}
    assert len(linked) > 100
    assert {i: r.component_id for i, r in got.items()} == expected
    assert all((r.n_links > 0) == any(i in pair for pair in linked) for i, r in got.items())


def test_matches_hold_all_common_seeds_and_runs():
    places = [np.array([5, 40, 0, 12, 24, 100, 112]), np.array([7, 300, 312, 324, 90])]
    seeds = [np.array([1, 2, 9, 9, 9, 9, 9]), np.array([2, 9, 9, 9, 11])]
    got = {tuple(m) for m in substring_dedup.matches(places[0], seeds[0], places[1], seeds[1]).tolist()}
    assert {(40, 7), (0, 300), (12, 312), (24, 324), (100, 300), (112, 312)} <= got and {m[1] for m in got} == {7, 300, 312, 324}


def run_text(rng):
    words = []
    while len(words) < 200:
        words += rng.choice([[rng.randrange(5)] * rng.randrange(5, 90), [1000 + k for k in range(rng.randrange(40), rng.randrange(50, 120))], [rng.randrange(30)]])
    return np.array(words, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(77)


def test_pairs_compared_together_equal_one_by_one(monkeypatch):
    """Texts with runs of one repeated word; few of their many chains are aligned one by one."""
    rng = random.Random(23)
    with np.errstate(over="ignore"):
        texts, places, seeds = [run_text(rng) for _ in range(30)], [], []
        for text in texts:
            kmers = substring_dedup.grams(text, substring_dedup.KMER)[: len(text) - substring_dedup.KMER + 1]
            at = substring_dedup.text_seeds(kmers)
            kept = substring_dedup._thin(at, kmers[at].view(np.int64), at)
            places.append(at[kept])
            seeds.append(kmers[at].view(np.int64)[kept])
    left, right = np.array([(i, j) for i in range(30) for j in range(30) if i != j]).T
    expected, aligned = [], 0
    for pair, (i, j) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        found = substring_dedup.matches(places[i], seeds[i], places[j], seeds[j])
        if len(found):
            x, y = found.T
            parts = sorted(substring_dedup.chains(x, y), key=lambda c: (x[c[0]], y[c[0]]))
            ends = [[v[c[at]] for c in parts] for at in (0, -1) for v in (x, y)]
            group = substring_dedup.joined([0] * len(parts), *ends)
            for head in sorted(set(group)):
                chain = np.concatenate([c for c, g in zip(parts, group, strict=True) if g == head])
                if min(x[chain[-1]] - x[chain[0]], y[chain[-1]] - y[chain[0]]) + substring_dedup.KMER >= substring_dedup.LEAST_SPAN:
                    aligned += 1
                    runs = substring_dedup.align(texts[i], texts[j], x[chain], y[chain])
                    expected += [(pair, *row) for row in substring_dedup.stretches(runs, 50, 0.8)]
    calls, align = [], substring_dedup.align
    monkeypatch.setattr(substring_dedup, "align", lambda *a: calls.append(a) or align(*a))
    bags = substring_dedup._Bags(np.concatenate(places), np.concatenate(seeds), np.array([len(p) for p in places]))
    words = substring_dedup._Texts(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
    got = substring_dedup.pair_passages(bags, words, left, right, 50, 0.8)
    assert len(expected) > 200 and sorted(map(tuple, got.tolist())) == sorted(tuple(map(int, row)) for row in expected)
    assert len(calls) < aligned / 2


def test_tiles_are_filled_in_rounds_and_scratch_tables_go(spark, monkeypatch, tmp_path):
    rng = random.Random(21)
    shared = [prose(rng, 70) for _ in range(4)]
    texts = [" ".join([*prose(rng, 30), *shared[i % 4], *prose(rng, 30)]) for i in range(24)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], cases.DOCS)
    made, at_once = [], substring_dedup.materialize
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    monkeypatch.setattr(substring_dedup, "materialize", lambda spark, df, name: made.append(name) or at_once(spark, df, name))
    found = []
    for tile_pairs, texts_at_once, least in ((1 << 14, 2, 1 << 28), (4, 0, 6_000)):
        monkeypatch.setattr(substring_dedup, "TILE_PAIRS", tile_pairs)
        monkeypatch.setattr(substring_dedup, "ROUND_TEXTS", texts_at_once)
        monkeypatch.setattr(substring_dedup, "ROUND_BYTES", least)
        made.clear()
        found.append(sorted(map(tuple, substring_dedup.repeated_passages(spark, docs).drop("spans").collect())))
        assert (made.count("passages") > 5) == (least == 6_000)
    assert found[0] == found[1] and sum(row[5] > 0 for row in found[0]) > 20
    left = {name.split("-", 1)[1].rsplit("-", 1)[0] for name in os.listdir(tmp_path)}
    assert "passages" in left and not left & {"seeds", "keys", "key-ends", "stars", "apart", "pairs", "tiles", "tile-texts", "passage-texts"}
    with pytest.raises(ValueError, match="no scratch table"):
        docs.write.parquet(f"{tmp_path}/other")
        session.discard(spark.read.parquet(f"{tmp_path}/other"))


def test_blocks_equal_those_of_difflib():
    rng = random.Random(24)
    for _ in range(500):
        kinds = rng.choice([1, 2, 3, 8])
        a, b = (np.array([w for _ in range(rng.randrange(1, 14)) for w in [rng.randrange(kinds)] * rng.choice([1, 1, 2, 5, 9])], dtype=np.uint64) for _ in range(2))
        equal = difflib.SequenceMatcher(None, a.tolist(), b.tolist(), autojunk=False).get_matching_blocks()
        found = []
        for block in substring_dedup.blocks(a, b):
            substring_dedup._add(found, *block)
        assert found == [list(block) for block in equal if block.size]


def test_passages_of_edge_rows(spark):
    got = substring_dedup.repeated_passages(spark, cases.with_clashing_columns(cases.edge_docs(spark))).collect()
    assert len(got) == len(cases.edge_rows())
    named = {r.doc_id: r for r in got if r.doc_id is not None}
    assert named[106].class_id == 105 and named[106].copies == 2 and named[106].repeated_words == 60_000
    assert named[100].n_words == 0 and not named[100].spans
    assert substring_dedup.repeated_passages(spark, cases.empty_docs(spark)).count() == 0


QUESTION = "Maria has 12 apples and gives 5 of them to Peter in the garden. How many apples does Maria have after 3 days?"
# One name twice: a text that exchanges only one of them still holds 14 words as they are.
TWICE = "we heard that Maria saw 7 birds near the mill and that Maria counted them for an hour"
BENCHMARK = "item_id bigint, text string, items int"


def test_leaks_and_exchanged_values(spark):
    rng = random.Random(2)
    around = lambda x: f"{' '.join(prose(rng, 40))}. {x} {' '.join(prose(rng, 40))}"
    other = QUESTION.replace("Maria", "Olga").replace("Peter", "Ivan").replace("12", "30").replace("5", "1,750.5")
    torn = TWICE.replace("Maria", "Olga", 1)
    texts = [around(QUESTION), around(other), around(QUESTION.lower().replace("?", "")), around("nothing"), torn, "apples and gives 5 of them"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], cases.DOCS)
    items = spark.createDataFrame([(7, QUESTION, 1), (8, None, 1), (None, QUESTION, 1), (9, "", 1), (7, QUESTION, 1), (10, "too short", 1), (11, TWICE, 1)], BENCHMARK)
    got = {r.doc_id: r for r in decontamination.mark_leaks(spark, docs, items).collect()}
    assert [got[i].leaked for i in range(6)] == [True, True, True, False, True, False]
    again = docs.limit(0).union(spark.createDataFrame([(9, TWICE.replace("Maria", "Olga"), "en", "s", 0)], cases.DOCS))
    assert [r.items for r in decontamination.mark_leaks(spark, again, items).collect()] == [[11]]
    assert got[0].items == [7] and not got[0].reparameterised and got[1].reparameterised


def leaked(spark, item, *texts):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], cases.DOCS)
    items = spark.createDataFrame([(7, item, 1)], BENCHMARK)
    return [r.leaked for r in decontamination.mark_leaks(spark, docs, items).orderBy("doc_id").collect()]


def test_copies_in_any_letter_case_are_leaks(spark):
    """Recall of planted copies in each case, against a plain join of lower-cased words; other texts stay clean."""
    rng = random.Random(12)
    names = ["Maria", "Peter", "Paris", "Olga"]
    items = [" ".join(rng.choice([*names, str(rng.randrange(99)), *prose(rng, 6)]) for _ in range(rng.choice([9, 16, 30]))) for _ in range(30)]
    forms = [str, str.lower, str.upper, str.title]
    texts = [f"{' '.join(prose(rng, 30))} . {form(item)} . {' '.join(prose(rng, 30))}" for item in items for form in forms]
    clean = [" ".join(prose(rng, 60)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate([*texts, *clean])], cases.DOCS)
    table = spark.createDataFrame([(i, item, 1) for i, item in enumerate(items)], BENCHMARK)
    got = {r.doc_id: r for r in decontamination.mark_leaks(spark, docs, table).collect()}
    for i in range(len(texts)):
        assert got[i].leaked and i // 4 in got[i].items and (i % 4 > 0 or not got[i].reparameterised), texts[i]
    assert not any(got[i].leaked for i in range(len(texts), len(texts) + 40))


def test_one_changed_value_does_not_hide_a_leak(spark):
    apart = "she bought 2 apples at the old market and waited there for 2 hours until the rain was over"
    assert leaked(spark, apart, apart.replace("2 hours", "5 hours"), apart.replace("2", "3"), "she bought 2 apples") == [True, True, False]
    rng = random.Random(3)
    words = ["x", "Maria", *prose(rng, 30), "Maria", *prose(rng, 30), "Maria", *prose(rng, 30)]
    changed = [*words]
    changed[32] = "Olga"
    assert leaked(spark, " ".join(words), " ".join(changed), " ".join(prose(rng, 90))) == [True, False]


def test_names_that_open_sentences_and_items_full_of_numbers(spark):
    short = "Maria has many red apples. Maria gives most of them away. Maria eats the rest at home."
    assert leaked(spark, short, short, short.replace("Maria", "Olga"), short.replace("Maria", "He")) == [True, True, True]
    numbers = "sum of 3 5 7 9 11 13 15 and 17 19 21 23 25 is"
    assert leaked(spark, numbers, f"so the {numbers} what", numbers.replace("7", "8").replace("21", "20"), "sum of 3 5 7") == [True, False, False]


def brute_template(text):
    import pyarrow as pa

    from tapeloom.llm.tokens import text_bytes

    with np.errstate(over="ignore"):
        return decontamination.templates(*text_bytes(pa.array([text])))


def test_templates():
    a, values, _ = brute_template("He met Anna and 3.5 km later Anna. Then 1,000 five")
    b, other, _ = brute_template("He met Otto and 12 miles later Otto. Then 7 six")
    assert (a == b).all() and ((values == 0) == (other == 0)).all() and (values != other).any()
    assert len(a) == 11 and values[2] == values[7] != 0
    assert len(brute_template("")[0]) == 0


def test_exact_windows_equal_brute_force(spark):
    rng = random.Random(6)
    items = [" ".join(prose(rng, rng.choice([6, 9, 20, 40]))) for _ in range(12)]
    texts = []
    for i in range(60):
        body = prose(rng, 60)
        if i % 2:
            words = items[i % 12].split()
            body[10:10] = words[: rng.choice([len(words), 14, 12, 5])]
        texts.append(" ".join(body))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], cases.DOCS)
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], BENCHMARK)
    got = {r.doc_id: r.items for r in decontamination.mark_leaks(spark, docs, bench).collect()}
    for i, text in enumerate(texts):
        expected = []
        for j, item in enumerate(items):
            words = item.split()
            size = min(8, len(words))
            own = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
            held = {tuple(text.split()[k : k + size]) for k in range(len(text.split()) - size + 1)}
            if len(own & held) >= min(6, -(-len(own) * 8 // 10)):
                expected.append(j)
        assert got[i] == expected


def test_leaks_of_edge_rows(spark):
    docs = cases.with_clashing_columns(cases.edge_docs(spark))
    items = spark.createDataFrame([(1, cases.PROSE[0], 1)], BENCHMARK)
    marked = decontamination.mark_leaks(spark, docs, items)
    rows = marked.collect()
    assert len(rows) == len(cases.edge_rows()) and set(docs.columns) <= set(marked.columns)
    assert all(r.leaked == (r.text is not None and r.text.startswith(cases.PROSE[0])) for r in rows)
    assert decontamination.mark_leaks(spark, docs, items.limit(0)).filter("leaked").count() == 0
    assert decontamination.mark_leaks(spark, cases.empty_docs(spark), items).count() == 0
