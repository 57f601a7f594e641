"""Jaccard join of word n-gram sets, size-aware: subsets of small sets, inverted lists for large ones.

1. A text becomes the set of its distinct word n-grams (64-bit hashes). Texts of equal sets are one class; only classes
   are compared, so copies are never expanded.
2. n-grams that recur often in a run of documents are counted over all runs. The most frequent ones (`HOT_MOST` at most,
   a fixed bound) rank last, the others by their hash: any common order is exact, this one keeps lists short.
3. Small classes: two sets of sizes s <= t reach the threshold exactly if they share c(s, t) elements. Each set lists
   its subsets of c elements, hashed together with (s, t); all sets under one key are linked, so a key needs two stars, the
   smallest class of either size, and no comparison at all.
4. Large classes: if two sets reach the threshold they share one of the first s - ceil(p s) + 1 elements of their order.
   Each set enters the inverted lists of these elements, with the number of its elements from there on (`rest`): what
   two sets share first bounds what they share at all, so in that list both rests reach c(s, t). A set scans its lists:
   every member meets the list's center, the class that has the most company over all its lists.
5. The boundary between small and large is where the subsets, counted over the size histogram, and the list entries to
   scan, counted on the lists themselves, are fewest together; a size is never enumerated beyond `SMALL_MOST`.
6. Pairs whose sizes, or whose parity sketches (which bound the difference of two sets for certain), rule the threshold
   out are dropped; the others are confirmed on the full sets, built again from the texts.
7. A list whose members are not yet one component may hide links between members other than its center. These are
   compared across components, in square blocks of `BLOCK_ROWS`, so that a long list is many tasks.

Null and empty texts, and texts without words, have no n-grams: size 0, linked with nothing. Rows with a null id take
no part: `component_id` is null. Rows that repeat an id are judged each by its own text. Very long texts are sets like any
other. Ties do not arise: the smallest id of a component is its name. Only `doc_id` and `text` are read. Empty table:
empty result.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.llm.components import connected
from tapeloom.llm.minhash_dedup import _confirmed, differing, parity_sketch, set_key, text_sets
from tapeloom.llm.tokens import mix, seeds, signed, word_pieces
from tapeloom.session import materialize

SMALL_MOST = 48
HOT_MOST, HOT_LEAST = 1 << 18, 64
RUN_ELEMENTS = 1 << 22
BLOCK_ROWS = 512
_SUBSET, _SIZES = seeds(2, 1212)


def shared_least(s: int, t: int, percent: int) -> int:
    """Elements that sets of these sizes must share to reach the threshold."""
    return -(-percent * (s + t) // (100 + percent))


def prefix_length(s: int, percent: int) -> int:
    return s - -(-percent * s // 100) + 1


def partner_sizes(s: int, percent: int) -> range:
    """Sizes a partner of a set of size s may have."""
    return range(-(-percent * s // 100), 100 * s // percent + 1)


def _recurring(size: int):
    """n-grams that recur in a run of documents, with the number of documents of the run that hold them."""

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        every, counts = np.unique(np.concatenate(sets), return_counts=True)
        often = counts >= max(4, len(sets) // 1024)
        return pa.RecordBatch.from_pydict({"token": signed(every[often]), "n": pa.array(counts[often], pa.int64())})

    def count(batches):
        sets, held = [], 0
        for batch in batches:
            with np.errstate(over="ignore"):
                for _, words, bounds in word_pieces(batch.column("text")):
                    for s in text_sets(words, bounds, size):
                        sets.append(s)
                        held += len(s)
                        if held >= RUN_ELEMENTS:
                            yield counted(sets)
                            sets, held = [], 0
        if held:
            yield counted(sets)

    return count


def frequent_elements(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and counts of the most frequent n-grams, at most `HOT_MOST`; the rest needs no order."""
    counts = docs.select("text").mapInArrow(_recurring(size), "token bigint, n bigint")
    counts = counts.groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_LEAST)
    counts = materialize(docs.sparkSession, counts, "frequent")
    scale = F.floor(F.log2("n"))
    held, least = 0, None
    for row in counts.groupBy(scale.alias("scale")).count().orderBy(F.desc("scale")).collect():
        held += row["count"]
        if held > HOT_MOST:
            break
        least = row.scale
    if least is None:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    table = counts.filter(scale >= least).toArrow()
    tokens = table.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], table.column("n").to_numpy()[order]


def _describe(size: int, percent: int, hot: np.ndarray, frequency: np.ndarray):
    """Per row: class, size, parity sketch and the first elements of the set; all of them if the set may be small."""

    def first_elements(s: np.ndarray) -> np.ndarray:
        rank = np.zeros(len(s), dtype=np.int64)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
            rank = np.where(hot[at] == s, frequency[at], 0)
        kept = len(s) if len(s) <= SMALL_MOST else prefix_length(len(s), percent)
        return s[np.lexsort((s, rank))[:kept]]

    def describe(batches):
        for batch in batches:
            counts, keys, sketches, elements, ends = [], [], [], [np.zeros(0, dtype=np.uint64)], [0]
            with np.errstate(over="ignore"):
                for _, words, bounds in word_pieces(batch.column("text")):
                    for s in text_sets(words, bounds, size):
                        counts.append(len(s))
                        keys.append(set_key(s))
                        sketches.append(parity_sketch(s))
                        elements.append(first_elements(s))
                        ends.append(ends[-1] + len(elements[-1]))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array(counts, pa.int64()),
                    "class": pa.array(signed(np.array(keys, dtype=np.uint64)), pa.int64()),
                    "parity": pa.array(sketches, pa.list_(pa.int64())),
                    "elements": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(np.concatenate(elements)))),
                }
            )

    return describe


def subset_count(s: int, sizes: set[int], percent: int) -> int:
    """Subsets a set of size s lists for partners of the given sizes."""
    return sum(math.comb(s, shared_least(s, t, percent)) for t in partner_sizes(s, percent) if t in sizes)


def boundary(histogram: dict[int, int], scanned: dict[int, int], percent: int) -> int:
    """Largest small size: up to it subsets, beyond it list entries; both together are fewest."""
    best, least = 0, math.inf
    sizes = {s for s in histogram if s <= SMALL_MOST}
    rest, listed = sum(scanned.get(s, 0) for s in sizes), 0
    for s in [0, *sorted(sizes)]:
        listed += histogram.get(s, 0) * subset_count(s, sizes, percent)
        rest -= scanned.get(s, 0)
        if listed + rest < least:
            best, least = s, listed + rest
    return best


def subset_keys(elements: np.ndarray, sizes: set[int], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set's subsets for each partner size, and whether the set is the larger of the two."""
    s = len(elements)
    keys, larger = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=bool)]
    parts = mix(elements ^ _SUBSET)
    whole = np.add.reduce(parts)
    for t in partner_sizes(s, percent):
        if t not in sizes:
            continue
        left_out = s - shared_least(s, t, percent)
        sums = np.zeros(1, dtype=np.uint64)
        if left_out == 1:
            sums = parts
        elif left_out > 1:
            chosen = np.fromiter(itertools.chain.from_iterable(itertools.combinations(range(s), left_out)), dtype=np.int64)
            sums = np.add.reduce(parts[chosen.reshape(-1, left_out)], axis=1)
        pair = mix(np.array([min(s, t) * (1 << 20) + max(s, t)], dtype=np.uint64) * _SIZES)
        keys.append(mix((whole - sums) ^ pair))
        larger.append(np.full(len(sums), s > t))
    return np.concatenate(keys), np.concatenate(larger)


def _subsets(sizes: set[int], percent: int):
    def subsets(batches):
        for batch in batches:
            ids = batch.column("class").to_numpy()
            for i, elements in enumerate(batch.column("elements")):
                with np.errstate(over="ignore"):
                    keys, larger = subset_keys(elements.values.to_numpy().view(np.uint64), sizes, percent)
                if len(keys):
                    yield pa.RecordBatch.from_pydict(
                        {"key": signed(keys), "class": pa.array(np.full(len(keys), ids[i])), "larger": pa.array(larger)}
                    )

    return subsets


def _small_links(classes: DataFrame, sizes: set[int], percent: int) -> DataFrame:
    """`left`, `right`: links that connect what the small classes' links connect."""
    small = classes.filter(F.col("n_shingles").isin(sorted(sizes))).select("class", "elements")
    keyed = small.mapInArrow(_subsets(sizes, percent), "key bigint, class bigint, larger boolean")
    keyed = materialize(classes.sparkSession, keyed, "subsets")
    stars = keyed.groupBy("key").agg(
        F.count("*").alias("n"),
        F.min(F.when(~F.col("larger"), F.col("class"))).alias("lesser"),
        F.min(F.when(F.col("larger"), F.col("class"))).alias("greater"),
    )
    # Sets of one size are linked among each other; of two sizes each is linked with all of the other size.
    stars = stars.filter("n > 1").select(
        "key", F.coalesce("greater", "lesser").alias("of_lesser"), F.col("lesser").alias("of_greater")
    )
    center = F.when(F.col("larger"), F.col("of_greater")).otherwise(F.col("of_lesser"))
    return (
        keyed.join(stars, "key")
        .select(F.col("class").alias("left"), center.alias("right"))
        .filter("left <> right")
        .distinct()
    )


def _possible(left: str, right: str, percent: int) -> Column:
    """Whether sizes and sketches leave the threshold possible.

    At the threshold at most (100 - p) / (100 + p) of both sizes together is in one set only.
    """
    a, b = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    near = (a * 100 >= b * percent) & (b * 100 >= a * percent)
    return F.when(near, differing(left, right) * (100 + percent) <= (a + b) * (100 - percent)).otherwise(False)


def _left_possible(pairs: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    return (
        pairs.alias("p")
        .join(described.alias("a"), F.col("p.left") == F.col("a.class"))
        .join(described.alias("b"), F.col("p.right") == F.col("b.class"))
        .filter(_possible("a", "b", percent))
        .select("left", "right")
    )


def _far_enough_ahead(a: str, b: str, percent: int) -> Column:
    """Whether this can be the first element that two list members at the threshold share."""
    sizes = F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")
    return F.least(f"{a}.rest", f"{b}.rest") * (100 + percent) >= sizes * percent


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("left"), F.greatest(a, b).alias("right")]


def _across(members: DataFrame, percent: int) -> DataFrame:
    """`left`, `right`: pairs of members of one list (`token`, `class`, `n_shingles`, `rest`, `root`) across components.

    Members outside the list's largest component meet all others; lists are cut into square blocks.
    """
    roots = members.groupBy("token", "root").agg(F.count("*").alias("n"))
    lists = roots.groupBy("token").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"),
        F.count("*").alias("roots"),
        F.sum("n").alias("all_rows"),
        (F.sum("n") - F.max("n")).alias("other_rows"),
    )
    blocks = [F.ceil(F.col(c) / BLOCK_ROWS).alias(f"{c}_blocks") for c in ("all_rows", "other_rows")]
    lists = lists.filter("roots > 1").select("token", "main", *blocks)
    opened = materialize(members.sparkSession, members.join(lists, "token"), "open")

    def dealt(rows: DataFrame, own: str, other: str, salt: int, names: tuple[str, str]) -> DataFrame:
        deal = F.pmod(F.xxhash64("class", F.lit(salt)), F.col(own))
        return rows.withColumns({names[0]: deal, names[1]: F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))})

    outside = dealt(opened.filter("root <> main"), "other_rows_blocks", "all_rows_blocks", 1, ("i", "j"))
    everyone = dealt(opened, "all_rows_blocks", "other_rows_blocks", 2, ("j", "i"))
    a, b = outside.alias("a"), everyone.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("token", "i", "j")]
    once = (F.col("b.root") == F.col("b.main")) | (F.col("a.class") < F.col("b.class"))
    met = a.join(b, same[0] & same[1] & same[2] & (F.col("a.root") != F.col("b.root")) & once & _far_enough_ahead("a", "b", percent))
    return met.select(*_pair("a.class", "b.class")).distinct()


def similar_sets(spark: SparkSession, docs: DataFrame, *, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` for each row of `docs` (`doc_id`, `text`).

    Texts are linked when 100 * intersection >= percent * union of their sets of `shingle_words`-word n-grams; a
    component is what links connect, named by its smallest id.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hot, frequency = frequent_elements(docs, shingle_words)
    rows = docs.mapInArrow(
        _describe(shingle_words, percent, hot, frequency),
        "doc_id bigint, n_shingles bigint, class bigint, parity array<bigint>, elements array<bigint>",
    )
    rows = materialize(spark, rows, "sets")
    present = rows.filter("doc_id is not null and n_shingles > 0")
    classes = materialize(
        spark,
        present.groupBy("class").agg(
            F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n_shingles", "parity", "elements")]
        ),
        "classes",
    )
    prefix = F.slice("elements", F.lit(1), (F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1).cast("int"))
    entries = classes.select(F.posexplode(prefix).alias("place", "token"), "class", "n_shingles")
    entries = entries.select("token", "class", "n_shingles", (F.col("n_shingles") - F.col("place")).alias("rest"))

    # The boundary: subsets against list entries of the sizes that may be small.
    histogram = {r.n_shingles: r["count"] for r in classes.filter(F.col("n_shingles") <= SMALL_MOST).groupBy("n_shingles").count().collect()}
    some = entries.filter(F.col("n_shingles") <= 100 * SMALL_MOST // percent)
    by_size = some.groupBy("token", "n_shingles").agg(F.count("*").alias("n"))
    of_list = by_size.join(by_size.groupBy("token").agg(F.sum("n").alias("length")), "token")
    scanned = {r.n_shingles: r.cost for r in of_list.groupBy("n_shingles").agg(F.sum(F.col("n") * F.col("length")).alias("cost")).collect()}
    small_most = boundary(histogram, scanned, percent)
    sizes = {s for s in histogram if s <= small_most}
    links = _small_links(classes, sizes, percent)

    # Large classes, and the small ones a large one may be linked with, enter the lists.
    listed = entries.filter(F.col("n_shingles") * 100 >= percent * (small_most + 1))
    in_list = F.count("*").over(Window.partitionBy("token")).alias("length")
    crowded = materialize(spark, listed.select("*", in_list).filter("length > 1"), "lists")
    company = crowded.groupBy("class").agg(F.sum("length").alias("company"))
    first = F.max_by(F.struct("class", "n_shingles", "rest"), F.struct("company", "class")).alias("head")
    heads = crowded.join(company, "class").groupBy("token").agg(first).select("token", "head.*")
    described = classes.select("class", "n_shingles", "parity")
    met = crowded.alias("a").join(heads.alias("b"), "token").filter(_far_enough_ahead("a", "b", percent))
    pairs = met.filter("a.class <> b.class").select(*_pair("a.class", "b.class")).distinct()
    pairs = materialize(spark, _left_possible(pairs, described, percent), "pairs")
    links = links.union(_confirmed(spark, docs, classes, pairs, shingle_words, percent))
    links = materialize(spark, links, "links")
    roots = connected(spark, links, "left", "right")

    rooted = crowded.filter("length > 2").join(roots.withColumnRenamed("node", "class"), "class", "left")
    rooted = rooted.select("token", "class", "n_shingles", "rest", F.coalesce("root", "class").alias("root"))
    other = _across(materialize(spark, rooted, "rooted"), percent)
    other = materialize(spark, _left_possible(other.join(pairs, ["left", "right"], "left_anti"), described, percent), "pairs")
    if other.limit(1).count():
        links = materialize(spark, links.union(_confirmed(spark, docs, classes, other, shingle_words, percent)), "links")
        roots = connected(spark, links, "left", "right")

    named = materialize(spark, roots.join(classes.select("doc_id", F.col("class").alias("node")), "node"), "roots")
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    grouped = named.join(names, "root").select(F.col("node").alias("class"), "component_id")
    component = classes.join(grouped, "class", "left").select("class", F.coalesce("component_id", "doc_id").alias("component_id"))
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    linked = rows.filter(~alone).join(component, "class").select("doc_id", "n_shingles", "component_id")
    return linked.union(rows.filter(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
