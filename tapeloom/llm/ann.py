"""Approximate nearest neighbours by learned partitions.

1. A sample of vectors, chosen by hash, gets its graph of nearest neighbours; the graph is cut into parts of
   equal size by recursive bisection (spectral order, then swaps that keep balance). There is a part for each
   `PART_ROWS` rows, from `PARTS` to `MOST_PARTS`, and at most `SAMPLE_ROWS`, or 64 a part, in the sample.
2. A small network learns to tell, from a vector, in which parts its neighbours lie.
3. Every row is indexed: it belongs to the part the network finds most probable.
4. A query goes to its most probable parts, and all their vectors are ranked by the exact measure. How many
   parts is measured: the fewest with which `recall` of the true neighbours of up to `check_queries`
   queries, found by comparing these with every row, lie in the parts they go to.

Vectors of a part are dealt into blocks of bounded size, so a part that holds a third of all rows, or many
copies of one vector, is searched by many tasks. No vector is copied: a task holds one block and reads the
queries routed to its part behind it, some at a time. Nearness is the inner product in double precision,
summed in the order of the components: equal vectors have equal scores, ties go to the smaller id.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part,
nor do rows with a null id. All rows with the query's id are its own. Repeated queries count once, repeated
candidate rows are candidates each. Fewer candidates than wanted: all of them. Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tapeloom.session import materialize

SAMPLE_ROWS, NEIGHBOURS, PARTS, MOST_PARTS, PART_ROWS = 4096, 12, 32, 1024, 50_000
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 2_000
FOUND = "query_id bigint, vec_id bigint, score double"


def _matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype=dtype)


def sample_graph(vectors: np.ndarray, neighbours: int) -> np.ndarray:
    """Nearest other sample rows of each sample row, by inner product."""
    neighbours = min(neighbours, len(vectors) - 1)
    result = np.zeros((len(vectors), neighbours), dtype=np.int64)
    for begin in range(0, len(vectors), 512):
        near = vectors[begin : begin + 512] @ vectors.T
        near[np.arange(len(near)), np.arange(begin, begin + len(near))] = -np.inf
        result[begin : begin + 512] = np.argpartition(-near, neighbours - 1, axis=1)[:, :neighbours]
    return result


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """Part of each node: `parts` (a power of two) sets of equal size, with few edges between them."""
    rng = np.random.default_rng(seed)
    label = np.zeros(len(graph), dtype=np.int64)
    source, target = np.repeat(np.arange(len(graph)), graph.shape[1]), graph.reshape(-1)
    source, target = np.concatenate([source, target]), np.concatenate([target, source])
    size = 1
    while size < parts:
        inner = label[source] == label[target]
        a, b = source[inner], target[inner]
        degree = np.maximum(np.bincount(a, minlength=len(graph)), 1)
        value = rng.standard_normal(len(graph))
        for _ in range(40):
            mean = np.bincount(label, weights=value, minlength=size) / np.maximum(np.bincount(label, minlength=size), 1)
            value = value - mean[label]
            value = 0.5 * value + 0.5 * np.bincount(a, weights=value[b], minlength=len(graph)) / degree
            value /= max(np.abs(value).max(), 1e-12)
        order = np.lexsort((value, label))
        place = np.arange(len(graph)) - np.searchsorted(label[order], label[order])
        half = np.bincount(label, minlength=size)[label[order]] / 2
        side = np.zeros(len(graph), dtype=np.int64)
        side[order] = place >= half
        for _ in range(12):
            across = np.bincount(a, weights=side[a] != side[b], minlength=len(graph))
            gain = 2 * across - np.bincount(a, minlength=len(graph))
            moved = 0
            for part in range(size):
                left, right = (np.flatnonzero((label == part) & (side == s)) for s in (0, 1))
                left, right = left[np.argsort(-gain[left])], right[np.argsort(-gain[right])]
                pairs = min(len(left), len(right))
                swaps = int(((gain[left[:pairs]] + gain[right[:pairs]]) > 0).sum()) // 2
                side[left[:swaps]], side[right[:swaps]] = 1, 0
                moved += swaps
            if not moved:
                break
        label, size = 2 * label + side, 2 * size
    return label


class Router:
    """A network with one hidden layer that gives the probability of each part for a vector."""

    def __init__(self, width: int = 128, passes: int = 40, rate: float = 2e-3, seed: int = 5):
        self.width, self.passes, self.rate, self.seed = width, passes, rate, seed

    def fit(self, vectors: np.ndarray, wanted: np.ndarray) -> Router:
        rng = np.random.default_rng(self.seed)
        self.scale = 1 / max(float(np.sqrt((vectors**2).mean())), 1e-30)
        shapes = [(vectors.shape[1], self.width), (self.width,), (self.width, wanted.shape[1]), (wanted.shape[1],)]
        self.weights = [rng.standard_normal(s) * np.sqrt(2 / s[0]) if len(s) == 2 else np.zeros(s) for s in shapes]
        first = [np.zeros(s) for s in shapes]
        second = [np.zeros(s) for s in shapes]
        step = 0
        for _ in range(self.passes):
            order = rng.permutation(len(vectors))
            for begin in range(0, len(order), 128):
                rows = order[begin : begin + 128]
                x = vectors[rows] * self.scale
                w1, b1, w2, b2 = self.weights
                hidden = np.maximum(x @ w1 + b1, 0)
                error = (_softmax(hidden @ w2 + b2) - wanted[rows]) / len(rows)
                back = (error @ w2.T) * (hidden > 0)
                step += 1
                for i, g in enumerate((x.T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                    g = g + 1e-4 * self.weights[i]
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    m, v = first[i] / (1 - 0.9**step), second[i] / (1 - 0.999**step)
                    self.weights[i] -= self.rate * m / (np.sqrt(v) + 1e-8)
        return self

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return _softmax(np.maximum(vectors * self.scale @ w1 + b1, 0) @ w2 + b2)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit_router(vectors: np.ndarray, parts: int = PARTS, neighbours: int = NEIGHBOURS) -> Router | None:
    """A router for the vectors' space; None if they are too few for more than one part."""
    parts = min(parts, 1 << max(0, int(np.log2(max(len(vectors) / 64, 1)))))
    if parts < 2:
        return None
    graph = sample_graph(vectors, neighbours)
    label = balanced_parts(graph, parts)
    wanted = np.zeros((len(vectors), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(graph)), graph.shape[1]), label[graph.reshape(-1)]), 1.0)
    wanted[np.arange(len(vectors)), label] += 1
    return Router().fit(vectors, wanted / wanted.sum(axis=1, keepdims=True))


def usable(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `embedding` (doubles) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0)
    )
    common = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("embedding") == (common.n if common else 0))


def inner_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of the components."""
    total = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        total += queries[:, d] * vectors[:, d]
    return total


def nearest(query_ids, queries, ids, vectors, count: int) -> dict[str, np.ndarray]:
    """The `count` nearest of `vectors` for each query, ties by id. A matrix product finds the rows that can be
    among them, the scores are summed anew."""
    near = queries @ vectors.T
    near[query_ids[:, None] == ids[None, :]] = -np.inf
    rank = min(count, len(ids)) - 1
    limit = -np.partition(-near, rank, axis=1)[:, rank]
    margin = 1e-9 * (1 + np.abs(limit))
    row, column = np.nonzero((near >= (limit - margin)[:, None]) & np.isfinite(near))
    score = inner_products(queries[row], vectors[column])
    order = np.lexsort((ids[column], -score, row))
    row, column, score = row[order], column[order], score[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < count
    return {"query_id": query_ids[row[kept]], "vec_id": ids[column[kept]], "score": score[kept]}


def _indexed(router: Router | None):
    def run(batches):
        for batch in batches:
            vectors = _matrix(batch.column("embedding"))
            part = router.probabilities(vectors).argmax(axis=1) if router and len(vectors) else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_pydict(
                {"vec_id": batch.column("vec_id"), "embedding": batch.column("embedding"), "part": part.astype(np.int32)}
            )

    return run


def _routed(router: Router | None, sizes: np.ndarray, probes: int, count: int):
    """Parts each query goes to: the `probes` most probable, or more until they hold `count` other vectors."""

    def run(batches):
        for batch in batches:
            vectors = _matrix(batch.column("embedding"))
            chance = router.probabilities(vectors) if router and len(vectors) else np.ones((batch.num_rows, 1))
            order = np.argsort(-chance, axis=1, kind="stable")
            enough = (np.cumsum(sizes[order], axis=1) <= count).sum(axis=1) + 1
            parts = [o[: max(probes, e)].tolist() for o, e in zip(order, enough, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"vec_id": batch.column("vec_id"), "embedding": batch.column("embedding"), "parts": pa.array(parts, pa.list_(pa.int32()))}
            )

    return run


def _runs(batches, keys: list[str]):
    """Each batch in pieces of rows of equal `keys`, with the keys."""
    for batch in batches:
        if batch.num_rows:
            columns = np.stack([batch.column(k).to_numpy() for k in keys])
            cuts = np.flatnonzero((np.diff(columns) != 0).any(axis=0)) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                yield tuple(columns[:, begin].tolist()), batch.slice(begin, end - begin)


def _search(count: int):
    """Nearest rows of a block for the queries that follow it; rows come in order of part, block and `asks`."""

    def run(batches):
        here, held, waiting = None, [], []

        def answer():
            ids, vectors = (np.concatenate(x) for x in zip(*held, strict=True))
            queries = pa.Table.from_batches(waiting)
            for begin in range(0, queries.num_rows, BLOCK_QUERIES):
                asked = queries.slice(begin, BLOCK_QUERIES)
                found = nearest(asked.column("vec_id").to_numpy(), _matrix(asked.column("embedding")), ids, vectors, count)
                yield pa.RecordBatch.from_pydict(found)
            held[:] = [(ids, vectors)]
            waiting.clear()

        for (part, block, asks), rows in _runs(batches, ["part", "block", "asks"]):
            if (part, block) != here or sum(len(w) for w in waiting) >= BLOCK_QUERIES:
                if held and waiting:
                    yield from answer()
                if (part, block) != here:
                    here, held = (part, block), []
                    waiting.clear()
            if asks:
                waiting.append(rows)
            else:
                held.append((rows.column("vec_id").to_numpy(), _matrix(rows.column("embedding"))))
        if held and waiting:
            yield from answer()

    return run


def _compare_with_all(query_ids: np.ndarray, queries: np.ndarray, count: int):
    """The nearest rows of a task for each query: what its batches give is cut down again and again."""

    def run(batches):
        best = None
        for batch in batches:
            if batch.num_rows:
                ids, vectors = batch.column("vec_id").to_numpy(), _matrix(batch.column("embedding"))
                found = nearest(query_ids, queries, ids, vectors, count)
                part = dict(zip(ids.tolist(), batch.column("part").to_pylist(), strict=True))
                found["part"] = np.array([part[i] for i in found["vec_id"].tolist()], dtype=np.int32)
                if best is not None:
                    found = {name: np.concatenate([best[name], found[name]]) for name in found}
                order = np.lexsort((found["vec_id"], -found["score"], found["query_id"]))
                found = {name: values[order] for name, values in found.items()}
                first = np.searchsorted(found["query_id"], found["query_id"])
                kept = np.arange(len(order)) - first < count
                best = {name: values[kept] for name, values in found.items()}
        if best is not None:
            yield pa.RecordBatch.from_pydict(best)

    return run


def _best(found: DataFrame, count: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def probes_for(
    indexed: DataFrame, queries: DataFrame, router: Router, parts: int, recall: float, check_queries: int, count: int
) -> tuple[int, float]:
    """The fewest parts a query must go to, and the share of true neighbours found with them: measured for up
    to `check_queries` queries against every row."""
    rows = queries.orderBy(F.xxhash64(F.lit(2), "vec_id"), "vec_id").limit(check_queries).toPandas()
    if rows.empty:
        return 1, 1.0
    ids, vectors = rows["vec_id"].to_numpy(dtype=np.int64), np.array(rows["embedding"].tolist(), dtype=np.float64)
    found = indexed.mapInArrow(_compare_with_all(ids, vectors, count), f"{FOUND}, part int")
    true = _best(found, count).select("query_id", "part").toPandas()
    if true.empty:
        return 1, 1.0
    place = np.argsort(np.argsort(-router.probabilities(vectors), axis=1, kind="stable"), axis=1)
    row = {q: i for i, q in enumerate(ids.tolist())}
    at = np.array([place[row[q], p] for q, p in zip(true["query_id"], true["part"], strict=True)])
    share = np.cumsum(np.bincount(at, minlength=parts)) / len(at)
    probes = int(np.searchsorted(share, recall)) + 1
    return min(probes, parts), float(share[min(probes, parts) - 1])


def part_count(rows: int) -> int:
    """Parts for `rows` vectors: a power of two."""
    return min(MOST_PARTS, max(PARTS, 1 << max(0, -(-rows // PART_ROWS) - 1).bit_length()))


def search(
    spark: SparkSession,
    vectors: DataFrame,
    is_query: Column,
    *,
    count: int = 20,
    parts: int | None = None,
    sample_rows: int | None = None,
    recall: float = 0.96,
    check_queries: int = 256,
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score` of the `count` nearest rows found for each row that `is_query`.

    `parts` and `sample_rows` follow the number of rows unless they are given.
    """
    rows = usable(vectors)
    parts = parts or part_count(vectors.count())
    sample_rows = sample_rows or max(SAMPLE_ROWS, 64 * parts)
    sample = rows.orderBy(F.xxhash64(F.lit(1), "vec_id"), "vec_id").limit(sample_rows).select("embedding").toPandas()
    router = fit_router(np.array(sample["embedding"].tolist(), dtype=np.float64), parts) if len(sample) else None
    parts = len(router.weights[3]) if router else 1
    indexed = materialize(
        spark, rows.mapInArrow(_indexed(router), "vec_id bigint, embedding array<double>, part int"), "index"
    )
    queries = indexed.filter(is_query).select("vec_id", "embedding").dropDuplicates()
    sizes = np.zeros(parts, dtype=np.int64)
    for row in indexed.groupBy("part").count().collect():  # one row per part
        sizes[row["part"]] = row["count"]
    probes = probes_for(indexed, queries, router, parts, recall, check_queries, count)[0] if router else 1
    blocks = F.array(*[F.lit(int(-(-n // BLOCK_ROWS))) for n in np.maximum(sizes, 1)])
    routed = queries.mapInArrow(
        _routed(router, sizes, probes, count), "vec_id bigint, embedding array<double>, parts array<int>"
    )
    sent = (
        routed.withColumn("part", F.explode("parts"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(blocks, F.col("part") + 1) - 1)))
        .select("part", "block", F.lit(1).alias("asks"), "vec_id", "embedding")
    )
    block = F.pmod(F.xxhash64(F.lit(4), "vec_id"), F.element_at(blocks, F.col("part") + 1)).cast("int")
    stored = indexed.select("part", block.alias("block"), F.lit(0).alias("asks"), "vec_id", "embedding")
    together = stored.union(sent).repartition("part", "block").sortWithinPartitions("part", "block", "asks")
    return _best(together.mapInArrow(_search(count), FOUND), count).select("query_id", "rank", "vec_id", "score")
