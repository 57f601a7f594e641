"""Near-duplicate groups by b-bit MinHash, every link confirmed on the full shingle sets.

1. A text becomes the set of its distinct word shingles (hashed to 64 bits). Texts of equal sets are one
   class; from here on only classes are compared, so copies are never expanded.
2. A class gets `HASHES` minima. Each run of `ROWS` minima, whole, is a band key; of each minimum the low
   `BITS` bits are kept and packed by bit position, so that positions that agree are counted with two
   XORs, ORs and a bit count.
3. In a band bucket every class is paired with one center, not with every other class: with the class
   that has the most company over all its buckets, usually the text the others were made from. A pair
   whose signature agrees on too few positions is dropped: two random low parts agree in c = 2^-BITS
   of the positions, hence similarity = (agreeing / HASHES - c) / (1 - c). The limit lies so low that a
   pair at the threshold falls below it once in ten million.
4. A parity sketch refutes more pairs for certain: bit g of a set tells whether an odd number of its shingles
   hash to g, so two sketches differ in no more bits than the sets have elements of their own, and
   the threshold bounds these.
5. The remaining pairs are confirmed exactly: the sets of both classes are built again from the texts.
6. A bucket whose classes are not yet one component may hide links between classes other than its
   center. There, the classes outside the bucket's largest component are compared with all others of
   other components, by signature and sketch inside the join, and the survivors are confirmed too. Pairs
   within one component need no comparison: the component does not change.

With 32 bands of 4, a pair of similarity 0.8 shares no bucket with probability 5e-8.

Null and empty texts, and texts without words, have no shingles: size 0, linked with nothing. Rows with a
null id take no part: `component_id` is null and they are kept. Rows that repeat an id are judged each by
its own text. Ties do not arise: the smallest id of a component is its name. Empty table: empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.components import connected
from tapeloom.llm.mixing import small
from tapeloom.llm.tokens import mix, seeds, signed, word_pieces
from tapeloom.session import materialize

BANDS, ROWS, BITS = 32, 4, 2
HASHES = BANDS * ROWS
_STEP, _SHORT, _SET = seeds(3, 707)
_FACTORS = seeds(HASHES, 71) | np.uint64(1)
_SHIFTS = seeds(HASHES, 72)
_BAND = seeds(BANDS, 73)
_PLANES = BITS * HASHES // 64
MISS = 1e-7


def text_sets(words: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of `size` words of each text; of a shorter text its whole sequence."""
    shingles = words
    for j in range(1, size):
        shingles = mix(shingles[:-1] * _STEP + words[j:]) if len(shingles) > 1 else shingles[:0]
    sets = []
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end - begin >= size:
            sets.append(np.unique(shingles[begin : end - size + 1]))
        elif end > begin:
            whole = _SHORT + np.uint64(end - begin)
            for word in words[begin:end]:
                whole = mix(whole * _STEP + word)
            sets.append(np.array([whole], dtype=np.uint64))
        else:
            sets.append(words[:0])
    return sets


def set_key(shingles: np.ndarray) -> np.uint64:
    """Hash of a set: equal sets are one class."""
    return mix(np.add.reduce(mix(shingles ^ _SET)) * _STEP + np.uint64(len(shingles)))


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    filled = [s for s in sets if len(s)]
    minima = np.zeros((len(sets), HASHES), dtype=np.uint64)
    if filled:
        every = np.concatenate(filled)
        starts = np.cumsum([0] + [len(s) for s in filled[:-1]])
        rows = np.flatnonzero([len(s) > 0 for s in sets])
        for j in range(HASHES):
            minima[rows, j] = np.minimum.reduceat(every * _FACTORS[j] + _SHIFTS[j], starts)
    return mix(minima)


def row_key() -> Column:
    """Names a row by its id and text; rows that repeat both share it."""
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the set in a power of two of bits, at least twice its size, as words."""
    bits = max(512, 1 << int(2 * len(shingles) - 1).bit_length() if len(shingles) else 0)
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signatures(size: int):
    def sign(batches):
        for batch in batches:
            counts, keys, bands, planes, sketches = [], [], [], [], []
            with np.errstate(over="ignore"):
                for _, words, bounds in word_pieces(batch.column("text")):
                    sets = text_sets(words, bounds, size)
                    minima = _minima(sets)
                    counts += [len(s) for s in sets]
                    keys += [set_key(s) for s in sets]
                    sketches += [parity_sketch(s) for s in sets]
                    band = np.broadcast_to(_BAND, (len(sets), BANDS)).copy()
                    for j in range(ROWS):
                        band = mix(band * _STEP + minima[:, j::ROWS])
                    bands.append(band)
                    bits = [(minima >> np.uint64(b)) & np.uint64(1) for b in range(BITS)]
                    packed = [np.packbits(x.astype(np.uint8), axis=1).view(np.uint64) for x in bits]
                    planes.append(np.concatenate(packed, axis=1))
            bands = np.concatenate(bands) if bands else np.zeros((0, BANDS), dtype=np.uint64)
            planes = np.concatenate(planes) if planes else np.zeros((0, _PLANES), dtype=np.uint64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "row": batch.column("row"),
                    "n_shingles": pa.array(counts, pa.int64()),
                    "class": pa.array(signed(np.array(keys, dtype=np.uint64)), pa.int64()),
                    "bands": pa.ListArray.from_arrays(
                        pa.array(np.arange(len(bands) + 1, dtype=np.int32) * BANDS), pa.array(signed(bands.reshape(-1)))
                    ),
                    "parity": pa.array(sketches, pa.list_(pa.int64())),
                    **{f"plane{p}": signed(np.ascontiguousarray(planes[:, p])) for p in range(_PLANES)},
                }
            )

    return sign


def least_agreeing(percent: int) -> int:
    """Agreeing positions that a pair at the threshold falls below with probability `MISS` at most."""
    chance = 2.0**-BITS
    p = chance + (1 - chance) * percent / 100
    below = 0.0
    for k in range(HASHES + 1):
        below += math.comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)
        if below > MISS:
            return k
    return HASHES


def agreeing(left: str, right: str) -> Column:
    """Positions in which the low bits of two signatures agree."""
    words = HASHES // 64
    different = []
    for w in range(words):
        any_bit = F.lit(0).cast("long")
        for b in range(BITS):
            plane = f"plane{b * words + w}"
            any_bit = any_bit.bitwiseOR(F.col(f"{left}.{plane}").bitwiseXOR(F.col(f"{right}.{plane}")))
        different.append(F.bit_count(any_bit))
    return F.lit(HASHES) - sum(different[1:], different[0])


def differing(left: str, right: str) -> Column:
    """Bits in which two parity sketches differ; the longer one is folded to the length of the other."""
    a, b = F.col(f"{left}.parity"), F.col(f"{right}.parity")

    def fold(long: Column, short: Column) -> Column:
        n = F.size(short)
        return F.zip_with(F.slice(long, F.lit(1), n), F.slice(long, n + 1, n), lambda x, y: x.bitwiseXOR(y))

    def count(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, d: n + d)

    return (
        F.when(F.size(a) == F.size(b), count(a, b))
        .when(F.size(a) == 2 * F.size(b), count(fold(a, b), b))
        .when(F.size(b) == 2 * F.size(a), count(a, fold(b, a)))
        .otherwise(F.lit(0))
    )


def _alike(left: str, right: str, percent: int) -> Column:
    """Whether sizes, signatures and sketches leave the threshold possible.

    Similarity p / 100 or more means that at most (100 - p) / (100 + p) of both sizes together is in one set only.
    """
    a, b = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    near = (a * 100 >= b * percent) & (b * 100 >= a * percent) & (agreeing(left, right) >= least_agreeing(percent))
    return F.when(near, differing(left, right) * (100 + percent) <= (a + b) * (100 - percent)).otherwise(False)


def _build_sets(size: int):
    def build(batches):
        for batch in batches:
            sets, keep = [], []
            with np.errstate(over="ignore"):
                expected = batch.column("class").to_numpy().view(np.uint64)
                for row, words, bounds in word_pieces(batch.column("text")):
                    for i, s in enumerate(text_sets(words, bounds, size)):
                        if set_key(s) == expected[row + i]:
                            keep.append(row + i)
                            sets.append(s.tobytes())
            yield pa.RecordBatch.from_pydict(
                {"class": batch.column("class").take(pa.array(keep, pa.int64())), "shingles": pa.array(sets, pa.binary())}
            )

    return build


def _confirm(percent: int):
    def confirm(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                a = np.frombuffer(batch.column("left_set")[i].as_buffer(), dtype=np.uint64)
                b = np.frombuffer(batch.column("right_set")[i].as_buffer(), dtype=np.uint64)
                common = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_pydict(
                {name: batch.column(name).filter(pa.array(keep, pa.bool_())) for name in ("left", "right")}
            )

    return confirm


def _confirmed(spark, docs, classes, pairs, size, percent) -> DataFrame:
    """Pairs of classes whose full sets reach the threshold."""
    wanted = pairs.select(F.col("left").alias("class")).union(pairs.select("right")).distinct()
    chosen = classes.join(wanted, "class").select("class", "doc_id")
    sets = (
        docs.join(chosen, "doc_id")
        .select("class", "text")
        .mapInArrow(_build_sets(size), "class bigint, shingles binary")
        .dropDuplicates(["class"])
    )
    sets = materialize(spark, sets, "sets")
    return (
        pairs.join(sets.select(F.col("class").alias("left"), F.col("shingles").alias("left_set")), "left")
        .join(sets.select(F.col("class").alias("right"), F.col("shingles").alias("right_set")), "right")
        .mapInArrow(_confirm(percent), "left bigint, right bigint")
    )


def near_duplicates(
    spark: SparkSession, docs: DataFrame, *, shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`, `kept`, `row` for each row of `docs` (`doc_id`, `text`).

    Texts are linked when 100 * intersection >= percent * union of their sets of `shingle_words`-word
    shingles; a component is what links connect, `kept` marks its row of the smallest id.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("row")
    )
    planes = [f"plane{p}" for p in range(_PLANES)]
    described_by = ["n_shingles", "parity", *planes]
    signed_rows = docs.mapInArrow(
        _signatures(shingle_words),
        "doc_id bigint, row bigint, n_shingles bigint, class bigint, bands array<bigint>, parity array<bigint>, "
        + ", ".join(f"{p} bigint" for p in planes),
    )
    rows = materialize(spark, signed_rows, "signatures")
    present = rows.filter("doc_id is not null and n_shingles > 0")
    classes = materialize(
        spark,
        present.groupBy("class").agg(
            F.min("doc_id").alias("doc_id"),
            *[F.first(c).alias(c) for c in ("bands", *described_by)],
        ),
        "classes",
    )
    banded = classes.select("class", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    crowded = materialize(spark, banded.join(sizes, "band"), "crowded")
    company = crowded.groupBy("class").agg(F.sum("size").alias("company"))
    weighed = crowded.join(company, "class")
    heads = weighed.groupBy("band").agg(F.max(F.struct("company", "class")).alias("most"))
    heads = heads.select("band", F.col("most.class").alias("head"))
    shared = materialize(spark, crowded.join(heads, "band"), "bucketed")

    described = classes.select("class", *described_by)
    pairs = (
        shared.filter(F.col("class") != F.col("head"))
        .select(F.least("head", "class").alias("left"), F.greatest("head", "class").alias("right"))
        .distinct()
        .alias("p")
        .join(described.alias("a"), F.col("p.left") == F.col("a.class"))
        .join(described.alias("b"), F.col("p.right") == F.col("b.class"))
        .filter(_alike("a", "b", percent))
        .select("left", "right")
    )
    pairs = materialize(spark, pairs, "pairs")
    links = materialize(spark, _confirmed(spark, docs, classes, pairs, shingle_words, percent), "links")
    roots = connected(spark, links, "left", "right")

    # What stars around the smallest class can miss.
    rooted = (
        shared.filter("size > 2")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    most = (
        rooted.groupBy("band", "root")
        .agg(F.count("*").alias("n"))
        .groupBy("band")
        .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots"))
        .filter("roots > 1")
    )
    open_rows = materialize(
        spark, rooted.join(most, "band").join(described, "class").select("band", "head", "root", "main", *described.columns), "open"
    )
    other = (
        open_rows.filter("root <> main")
        .alias("a")
        .join(
            open_rows.alias("b"),
            (F.col("a.band") == F.col("b.band")) & (F.col("a.root") != F.col("b.root")) & _alike("a", "b", percent),
        )
        .select(F.least("a.class", "b.class").alias("left"), F.greatest("a.class", "b.class").alias("right"))
        .distinct()
        .join(pairs, ["left", "right"], "left_anti")
    )
    other = materialize(spark, other, "pairs")
    if other.limit(1).count():
        more = _confirmed(spark, docs, classes, other, shingle_words, percent)
        links = materialize(spark, links.union(more), "links")
        roots = connected(spark, links, "left", "right")

    roots = materialize(spark, roots, "roots")
    named = roots.join(classes.select("doc_id", F.col("class").alias("node")), "node")
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    grouped = roots.join(names, "root").select(F.col("node").alias("class"), "component_id")
    alone = classes.select("class", F.col("doc_id").alias("smallest"))
    return (
        rows.join(alone, "class", "left")
        .join(grouped, "class", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNull(), None)
            .when(F.col("n_shingles") == 0, F.col("doc_id"))
            .otherwise(F.coalesce("component_id", "smallest"))
            .alias("component_id"),
            "row",
        )
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
            "row",
        )
    )


def drop_near_duplicates(
    spark: SparkSession, docs: DataFrame, *, shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """`docs`, of each component only the row of the smallest id; of repeated rows one stays.

    Only the keys of rows that go are joined, so the texts move only if these are many.
    """
    judged = near_duplicates(spark, docs, shingle_words=shingle_words, percent=percent)
    judged = materialize(spark, judged, "judged")
    going = judged.filter("not kept").select("row").distinct()
    repeated = (
        judged.filter("kept and doc_id is not null and n_shingles > 0").groupBy("row").count().filter("count > 1").select("row")
    )
    keyed = docs.withColumn("dup_row", row_key())
    same = lambda other: F.col("dup_row") == other["row"]
    staying = keyed.join(small(going), same(going), "left_anti")
    if repeated.limit(1).count():
        twice = staying.join(small(repeated), same(repeated), "left_semi").dropDuplicates(["dup_row"])
        staying = staying.join(small(repeated), same(repeated), "left_anti").union(twice)
    return staying.select(*docs.columns)
