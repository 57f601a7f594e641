"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

1. Words are counted by Spark, with partial sums in every task. One occurrence in 31 (by a checksum of document and
   word) loses a letter, as if misspelt.
2. A word becomes the vector of its letter counts (`AXES` axes: a to z, the other letters folded onto the rest; counts
   end at 255). An edit moves such a vector little: a replaced letter takes one count down and one up (L1 distance two
   at most), an added letter takes one up (distance one). Folding and ending counts only bring vectors nearer. Vectors
   and the corners of boxes are also kept in unary digits (`DIGITS` a letter), so that a bit count is a distance.
3. Per length, a k-d tree over a bounded sample of the words (`SAMPLE_ROWS`) cuts the space into boxes of about
   `CELL_ROWS` words (more, if that leaves under `LEAST_SAMPLE` sampled words a box). Every word is stored in the box
   it lies in, and sent as a query to the boxes of its own length and of the next length that an edit can reach. A box
   that cannot be cut, since its words have equal counts, is dealt out by hash and its queries go to every deal.
4. A task reads the words of one box, builds a k-d tree with tight boxes and lets the queries pass through in batches.
   What the boxes leave is compared count by count, and then letter by letter.
5. A word's form is its near word of the largest count, if ten times as frequent. Forms are followed to the last one
   by doubling: n grows tenfold with each step, so few rounds do.

Any sample gives the same result; it only decides how even the boxes are. Null and empty texts hold no words; a null
id counts as empty text in the checksum. Very long texts and words are taken whole. Of near words with equal counts
the smallest in code-point order is the form. Rows that repeat an id count each. Only `doc_id` and `text` are read.
Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.tokens import mix, seeds, text_bytes
from tapeloom.session import materialize

LEAST_LETTERS = 7
SLIP = 31
AXES, DIGITS = 32, 4
CELL_ROWS = 4096
SAMPLE_ROWS = 1 << 18
LEAST_SAMPLE = 16
LEAF = 32
# Queries that pass a tree at once, and pairs whose letters are compared at once.
BLOCK, PAIRS = 1 << 14, 1 << 17
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Runs shorter than the least length cannot become words; a longer run is matched whole.
RUN = f"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}"


def word_counts(docs: DataFrame) -> DataFrame:
    """`word`, `n`: words of at least `LEAST_LETTERS` letters that occur twice or more, slips included."""
    run = F.explode(F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(RUN), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    runs = runs.withColumn("sum", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("sum") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("sum") % SLIP == 0, slipped).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter("n >= 2")


def unary(counts: np.ndarray) -> list[np.ndarray]:
    """Letter counts as columns of 64-bit words, a letter as `DIGITS` digits of which as many are one as it occurs."""
    ones = (np.uint64(1) << np.clip(counts, 0, DIGITS).astype(np.uint64)) - np.uint64(1)
    letters = 64 // DIGITS
    shifts = np.arange(letters, dtype=np.uint64) * np.uint64(DIGITS)
    return [np.bitwise_or.reduce(ones[:, i : i + letters] << shifts, axis=1) for i in range(0, AXES, letters)]


def missing(have: list[np.ndarray], wanted: list[np.ndarray]) -> np.ndarray:
    """Letters that `wanted` has beyond `have`."""
    return sum(np.bitwise_count(w & ~h) for h, w in zip(have, wanted, strict=True))


class Words:
    """Words of one column: their letters as bytes (code points up to 255), where each begins, and letter counts."""

    def __init__(self, column: pa.Array):
        data, bounds = text_bytes(column)
        lead = data == 0xC3  # the first of the two bytes of U+00C0 to U+00FF
        kept = np.concatenate([[0], np.cumsum(~lead)])
        self.letters = np.where(data >= 0x80, data + np.uint8(0x40), data)[~lead]
        self.starts = kept[bounds[:-1]]
        self.lengths = np.diff(kept[bounds])
        axis = np.where(self.letters < 0x80, self.letters - np.uint8(ord("a")), 26 + self.letters % 6).astype(np.int64)
        rows = np.repeat(np.arange(len(self.lengths)), self.lengths)
        counts = np.bincount(rows * AXES + axis, minlength=len(self.lengths) * AXES)
        self.counts = np.minimum(counts, 255).astype(np.int16).reshape(-1, AXES)
        self.bits = unary(self.counts)

    def matrix(self, rows: np.ndarray, length: int) -> np.ndarray:
        """The letters of words of one length, a row each."""
        return self.letters[self.starts[rows][:, None] + np.arange(length)]


class KdTree:
    """Median cuts of letter-count vectors on the axis of the greatest variance, down to `leaf` points.

    The boxes are tight around the points, or, for a tree that further points are dealt by, those of the cuts.
    """

    def __init__(self, points: np.ndarray, leaf: int, *, tight: bool):
        self.order = np.arange(len(points))
        self.axis, self.cut, self.children = [], [], []
        self.low, self.high, self.spans = [], [], []
        everything = np.full(AXES, -1, dtype=np.int16), np.full(AXES, 256, dtype=np.int16)
        self._add(points, 0, len(points), *everything)
        node = 0
        while node < len(self.axis):
            begin, end = self.spans[node]
            part = points[self.order[begin:end]]
            variance = part.var(axis=0) if end - begin > leaf else np.zeros(AXES)
            axis = int(variance.argmax())
            if variance[axis] > 0:
                values = part[:, axis]
                cut = min(int(np.median(values)), int(values.max()) - 1)
                side = values > cut
                middle = begin + int((~side).sum())
                self.order[begin:end] = np.concatenate([self.order[begin:end][~side], self.order[begin:end][side]])
                low, high = self.low[node], self.high[node]
                below, above = high.copy(), low.copy()
                below[axis], above[axis] = cut, cut + 1
                self.axis[node], self.cut[node] = axis, cut
                left = self._add(points, begin, middle, low, below)
                self.children[node] = left, self._add(points, middle, end, above, high)
            node += 1
        if tight:
            for node, (begin, end) in enumerate(self.spans):
                if end > begin:
                    part = points[self.order[begin:end]]
                    self.low[node], self.high[node] = part.min(axis=0), part.max(axis=0)
        self.least, self.most = unary(np.array(self.low)), unary(np.array(self.high))

    def _add(self, points, begin, end, low, high) -> int:
        self.axis.append(-1)
        self.cut.append(0)
        self.children.append(None)
        self.low.append(low)
        self.high.append(high)
        self.spans.append((begin, end))
        return len(self.axis) - 1

    def home(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves and the rows that lie in them."""
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if self.children[node] is None:
                yield node, rows
                continue
            above = points[rows, self.axis[node]] > self.cut[node]
            left, right = self.children[node]
            stack += [(left, rows[~above]), (right, rows[above])]

    def reach(self, bits: list[np.ndarray], up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, and the rows that `up` added and `down` removed letters can bring into their box."""
        stack = [(0, np.arange(len(bits[0])))]
        while stack:
            node, rows = stack.pop()
            part = [column[rows] for column in bits]
            least, most = [column[node] for column in self.least], [column[node] for column in self.most]
            rows = rows[(missing(part, least) <= up) & (missing(most, part) <= down)]
            if not len(rows):
                continue
            if self.children[node] is None:
                yield node, rows
            else:
                stack += [(child, rows) for child in self.children[node]]


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows that differ in exactly one letter, the one of `a` being smaller: each pair is met once."""
    different = a != b
    at = different.argmax(axis=1)
    rows = np.arange(len(a))
    return (different.sum(axis=1) == 1) & (a[rows, at] < b[rows, at])


def _one_added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows in which `b` is `a` with one more letter: what agrees from the left and from the right covers `a`."""
    from_left = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    from_right = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return from_left + from_right >= a.shape[1]


class Box:
    """The words stored in one box, all of one length, ready for queries."""

    def __init__(self, words: pa.Array, counts: pa.Array):
        self.column, self.n = words, counts
        self.words = Words(words)
        self.length = int(self.words.lengths[0])
        self.tree = KdTree(self.words.counts, LEAF, tight=True)
        self.ordered = [column[self.tree.order] for column in self.words.bits]

    def near(self, queries: Words, rows: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of query rows (words of `length` letters) and stored rows that are one edit apart."""
        up, down = (1, 0) if length < self.length else (1, 1)
        check = _one_added if length < self.length else _one_replaced
        asked = [column[rows] for column in queries.bits]
        for q, p in self._close(asked, up, down):
            step = max(1, (1 << 22) // self.length)
            for i in range(0, len(q), step):
                a, b = rows[q[i : i + step]], p[i : i + step]
                kept = check(queries.matrix(a, length), self.words.matrix(b, self.length))
                if kept.any():
                    yield a[kept], b[kept]

    def _close(self, asked: list[np.ndarray], up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of queries and stored rows whose letter counts an edit can turn into each other."""
        queries, stored, pairs = [], [], 0
        for leaf, found in self.tree.reach(asked, up, down):
            begin, end = self.tree.spans[leaf]
            b = [column[begin:end] for column in self.ordered]
            step = max(1, BLOCK * LEAF // (end - begin))
            for i in range(0, len(found), step):
                some = found[i : i + step]
                a = [column[some][:, None] for column in asked]
                q, p = np.nonzero((missing(a, b) <= up) & (missing(b, a) <= down))
                queries.append(some[q])
                stored.append(self.tree.order[begin + p])
                pairs += len(q)
            if pairs > PAIRS:
                yield np.concatenate(queries), np.concatenate(stored)
                queries, stored, pairs = [], [], 0
        if pairs:
            yield np.concatenate(queries), np.concatenate(stored)


class Router:
    """Boxes of every length, cut by a sample; box numbers are unique over all lengths."""

    def __init__(self, sample: list[str], rows: int):
        self.trees, self.first, self.deals = {}, {}, {}
        words = Words(pa.array(sample, pa.string()))
        share = len(sample) / max(rows, 1)
        size = max(LEAST_SAMPLE, int(CELL_ROWS * share))
        used = 0
        for length in np.unique(words.lengths).tolist():
            points = words.counts[words.lengths == length]
            tree = KdTree(points, size, tight=False)
            self.trees[length], self.first[length] = tree, used
            for node, (begin, end) in enumerate(tree.spans):
                if tree.children[node] is None:
                    self.deals[used + node] = max(1, -(-(end - begin) // (2 * size)))
            used += len(tree.spans)
        self.used = used

    def _box(self, length: int, node: int) -> int:
        # Lengths that the sample does not hold have one box each.
        return self.first[length] + node if length in self.trees else self.used + length

    def _none(self, points: np.ndarray):
        return [(0, np.arange(len(points)))]

    def send(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, boxes, deals and kinds (0 stored, 1 query) of everything that goes to boxes."""
        parts = []
        for length in np.unique(words.lengths).tolist():
            rows = np.flatnonzero(words.lengths == length)
            points, bits = words.counts[rows], [column[rows] for column in words.bits]
            tree = self.trees.get(length)
            for node, found in tree.home(points) if tree else self._none(points):
                box = self._box(length, node)
                deals = self.deals.get(box, 1)
                deal = np.zeros(len(found), dtype=np.int64)
                if deals > 1:
                    with np.errstate(over="ignore"):
                        letters = words.matrix(rows[found], length).astype(np.uint64)
                        deal = (mix((letters * seeds(length, 131)).sum(axis=1)) % np.uint64(deals)).astype(np.int64)
                parts.append((rows[found], box, deal, 0))
            for target, up, down in ((length, 1, 1), (length + 1, 1, 0)):
                tree = self.trees.get(target)
                for node, found in tree.reach(bits, up, down) if tree else self._none(points):
                    box = self._box(target, node)
                    for deal in range(self.deals.get(box, 1)):
                        parts.append((rows[found], box, np.full(len(found), deal), 1))
        if not parts:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none, none
        rows = np.concatenate([p[0] for p in parts])
        boxes = np.concatenate([np.full(len(p[0]), p[1], dtype=np.int64) for p in parts])
        kinds = np.concatenate([np.full(len(p[0]), p[3], dtype=np.int64) for p in parts])
        return rows, boxes, np.concatenate([p[2] for p in parts]), kinds


def _sender(router: Router):
    def send(batches):
        for batch in batches:
            rows, boxes, deals, kinds = router.send(Words(batch.column("word")))
            for i in range(0, len(rows), 1 << 16):
                part = slice(i, i + (1 << 16))
                taken = pa.array(rows[part])
                yield pa.RecordBatch.from_pydict(
                    {
                        "box": pa.array(boxes[part], pa.int64()),
                        "deal": pa.array(deals[part], pa.int64()),
                        "kind": pa.array(kinds[part], pa.int64()),
                        "word": batch.column("word").take(taken),
                        "n": batch.column("n").take(taken),
                    }
                )

    return send


def _answers(stored: list[pa.RecordBatch], box: Box | None, waiting: list[pa.RecordBatch]):
    """The box of `stored`, if not built yet, and the pairs it gives for the queries that wait."""
    asked = pa.Table.from_batches(waiting).combine_chunks()
    if box is None:
        table = pa.Table.from_batches(stored).combine_chunks()
        box = Box(table.column("word").chunk(0), table.column("n").chunk(0))
    column = asked.column("word").chunk(0)
    queries = Words(column)
    pairs = []
    for length in np.unique(queries.lengths).tolist():
        for a, b in box.near(queries, np.flatnonzero(queries.lengths == length), length):
            left, right = pa.array(a), pa.array(b)
            values = {"a": column.take(left), "a_n": asked.column("n").chunk(0).take(left)}
            values |= {"b": box.column.take(right), "b_n": box.n.take(right)}
            pairs.append(pa.RecordBatch.from_pydict(values))
    return box, pairs


def _search(batches):
    """Rows come box by box, stored words first; queries wait until there are `BLOCK` of them."""
    at, stored, box, waiting, rows = None, [], None, [], 0
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("box", "deal", "kind")], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if begin == end:
                continue
            key, kind = tuple(keys[begin, :2]), keys[begin, 2]
            if key != at:
                if waiting:
                    yield from _answers(stored, box, waiting)[1]
                at, stored, box, waiting, rows = key, [], None, [], 0
            run = batch.slice(begin, end - begin)
            if kind == 0:
                stored.append(run)
            elif stored:
                waiting.append(run)
                rows += end - begin
                if rows >= BLOCK:
                    box, pairs = _answers(stored, box, waiting)
                    yield from pairs
                    waiting, rows = [], 0
    if waiting:
        yield from _answers(stored, box, waiting)[1]


def near_words(spark: SparkSession, words: DataFrame) -> DataFrame:
    """`a`, `a_n`, `b`, `b_n`: every pair of `words` (`word`, `n`; letters up to U+00FF) one edit apart, once."""
    rows = words.count()
    step = max(-(-rows // SAMPLE_ROWS), CELL_ROWS // 64, 1)
    sample = [r.word for r in words.filter(F.pmod(F.xxhash64("word"), F.lit(step)) == 0).select("word").toLocalIterator()]
    sent = words.mapInArrow(_sender(Router(sample, rows)), "box bigint, deal bigint, kind bigint, word string, n bigint")
    dealt = sent.repartition("box", "deal").sortWithinPartitions("box", "deal", "kind")
    return dealt.mapInArrow(_search, "a string, a_n bigint, b string, b_n bigint")


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """`word`, `root` of the words of `forms` (`word`, `form`): where following forms ends."""
    current = materialize(spark, forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = current.join(further, "root", "left")
        current = joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        current = materialize(spark, current, "forms")
        if not current.filter("moved").limit(1).count():
            return current.select("word", "root")
        current = current.select("word", "root")


def spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n` of all words of `docs` (`doc_id`, `text`)."""
    words = materialize(spark, word_counts(docs), "words")
    pairs = near_words(spark, words)
    both = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
                F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
            )
        ).alias("pair")
    ).select("pair.*")
    first = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), first.alias("best"))
    enough = F.col("best.less") * -1 >= F.col("n") * 10
    judged = words.join(near, "word", "left").select(
        "word",
        F.when(enough, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    judged = materialize(spark, judged, "variants")
    roots = _roots(spark, judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
