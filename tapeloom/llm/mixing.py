"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in SQL alone.

1. Weights are shared out over the sources; a source gets `max_repeats` times its size at most, what it
   cannot give is shared by weight among the others until none is above.
2. A source's documents stand in an order permuted by a hash, read over and over: a stream of words that
   is cut at the target. The stream is dealt in blocks of `block_words` words; a document copy belongs
   to the block it begins in. So each source has an exact quota of blocks.
3. A tree splits the quotas among output shards: at each node the left half gets its share of all blocks,
   drawn without replacement, as a draw of blocks from all sources would give it (multivariate
   hypergeometric: one conditional hypergeometric draw per source, by inversion of a hash).
4. Each leaf takes the next blocks of each source's permuted stream: disjoint ranges. Within a shard the
   copies are shuffled: put into an order permuted by another hash (`local_order`, `placed_in_order`).

Ranks in a source or a shard come from counts of hash buckets and a window within one bucket, so a source
with a third of all rows is ordered by many tasks. Tables of one row per source are small beside the data;
they are broadcast only while `BROADCAST_ROWS` bounds them. The last copy of each source is cut to the
words that are left. All draws are hashes of the seed: reruns agree.

Null texts have size 0; documents of size 0 are never taken (`taken` 0, no placements). Null sources are
one source, last in the order. Null ids and repeated rows are rows like any other; identical rows may get
different shares. Other columns are kept, but for those beginning with `mix_` and those named as the columns
that are added, which are replaced. Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tapeloom.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
BROADCAST_ROWS = 100_000
ADDED = ("size", "source_size", "target", "taken", "placements", "stream_start")
BUCKETS, BUCKET_ROWS = 256, 1_000_000
SPREAD = 12  # standard deviations of a draw that are looked at: what lies beyond has probability 1e-30


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def small(df: DataFrame) -> DataFrame:
    """The frame marked for broadcast if its rows are few; as it is otherwise."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """`mix_number` and `target` of each source of `sizes` (`source`, `source_size`), a row per source.

    Sources that reach their limit are those whose limit per weight is smallest: with the sources in that
    order, a source is at its limit while its limit per weight is below what is left per weight.
    """
    every = W.partitionBy(F.lit(1))
    numbered = sizes.withColumn("mix_number", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("mix_number") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(max_repeats))
    by_limit = every.orderBy(F.col("mix_limit") / F.col("mix_weight"), "mix_number")
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    left = lambda total, part: F.sum(total).over(every) - F.coalesce(F.sum(part).over(before), F.lit(0.0))
    level = left("source_size", "mix_limit") / left("mix_weight", "mix_weight")
    return (
        numbered.withColumns({"mix_weight": weight, "mix_limit": limit})
        .withColumn("mix_level", level)
        .withColumn("mix_level", F.max("mix_level").over(every))
        .withColumn("target", F.least("mix_limit", F.col("mix_weight") * F.col("mix_level")))
        .select("source", "source_size", "mix_number", "target")
    )


def _draw(seed: int) -> str:
    """SQL of one hypergeometric draw: of `x` among `acc.pop` blocks, how many are among `acc.m` drawn ones."""
    u = f"shiftrightunsigned(xxhash64({seed}L, lo, hi, size(acc.left)), 11) * pow(2D, -53)"
    ratio = "(x - k) * CAST(acc.m - k AS DOUBLE) / ((k + 1) * CAST(acc.pop - x - acc.m + k + 1 AS DOUBLE))"
    mean = "(CAST(acc.m AS DOUBLE) * x / acc.pop)"
    sd = f"sqrt({mean} * (1D - CAST(x AS DOUBLE) / acc.pop) * (acc.pop - acc.m) / greatest(acc.pop - 1, 1L))"
    low = f"greatest(0L, acc.m + x - acc.pop, CAST(floor({mean} - {SPREAD} * {sd} - {SPREAD}) AS BIGINT))"
    high = f"least(x, acc.m, CAST(ceil({mean} + {SPREAD} * {sd} + {SPREAD}) AS BIGINT))"
    steps = f"sequence({low}, {high})"
    total = f"""aggregate({steps}, named_struct('w', 1D, 'sum', 0D),
        (s, k) -> named_struct('w', s.w * {ratio}, 'sum', s.sum + s.w), s -> s.sum)"""
    found = f"""aggregate({steps}, named_struct('w', 1D, 'sum', 0D, 'n', 0L, 'stop', {u} * {total}),
        (s, k) -> named_struct('w', s.w * {ratio}, 'sum', s.sum + s.w,
            'n', s.n + if(s.sum + s.w <= s.stop, 1L, 0L), 'stop', s.stop), s -> s.n)"""
    return f"""CASE WHEN x = 0 OR acc.m = 0 THEN 0L WHEN acc.m = acc.pop THEN x
        ELSE least({low} + {found}, {high}) END"""


def _split(seed: int) -> str:
    """SQL of the left child's quotas: one draw after another."""
    return f"""aggregate(quotas,
        named_struct('left', CAST(array() AS ARRAY<BIGINT>), 'pop', blocks, 'm', blocks * (mid - lo) DIV (hi - lo)),
        (acc, x) -> aggregate(array({_draw(seed)}), acc,
            (a, k) -> named_struct('left', array_append(a.left, k), 'pop', a.pop - x, 'm', a.m - k)),
        acc -> acc.left)"""


def split_quotas(root: DataFrame, shards: int, seed: int) -> DataFrame:
    """`shard`, `quotas` of each shard, given one row with the array `quotas` of all sources."""
    nodes = root.select("quotas", F.lit(0).alias("lo"), F.lit(shards).alias("hi"))
    while shards > 1:
        cut = nodes.withColumns(
            {
                "mid": F.expr("lo + (hi - lo) DIV 2").cast("int"),
                "blocks": F.expr("aggregate(quotas, 0L, (a, x) -> a + x)"),
            }
        ).withColumn("left", F.when(F.col("hi") - F.col("lo") > 1, F.expr(_split(seed))))
        nodes = cut.select(
            F.explode(
                F.expr(
                    """CASE WHEN left IS NULL THEN array(named_struct('quotas', quotas, 'lo', lo, 'hi', hi)) ELSE array(
                    named_struct('quotas', left, 'lo', lo, 'hi', mid),
                    named_struct('quotas', zip_with(quotas, left, (q, l) -> q - l), 'lo', mid, 'hi', hi)) END"""
                )
            ).alias("node")
        ).select("node.*")
        shards = -(-shards // 2)
    return nodes.select(F.col("lo").alias("shard"), "quotas")


def _bucket(order: Column, buckets: int) -> Column:
    return F.pmod(order, F.lit(buckets)).cast("int")


def bucket_count(rows: DataFrame) -> int:
    return max(BUCKETS, -(-rows.count() // BUCKET_ROWS))


def mix_plan(
    spark: SparkSession,
    docs: DataFrame,
    *,
    shards: int = 8,
    weights: tuple[float, ...] = WEIGHTS,
    max_repeats: int = 3,
    block_words: int = 4096,
    buckets: int | None = None,
    seed: int = 20,
) -> DataFrame:
    """`docs` (`doc_id`, `text`, `source`, others) with `size`, `source_size`, `target`, `taken`, `placements`
    (`copy`, `words`, `shard` of each copy taken) and `stream_start` (words of its source's stream before it), a
    row for each row.

    `buckets` is the number of hash buckets of a source; without one it follows the rows, about `BUCKET_ROWS` a bucket.
    """
    buckets = buckets or bucket_count(docs)
    sized = docs.drop(*ADDED).withColumns(
        {
            "size": word_count(F.col("text")),
            "mix_order": F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text").cast("string")),
        }
    ).withColumn("mix_bucket", _bucket(F.col("mix_order"), buckets))
    counted = materialize(
        spark, sized.groupBy("source", "mix_bucket").agg(F.sum("size").alias("mix_words")), "mix-buckets"
    )
    offset = F.sum("mix_words").over(W.partitionBy("source").orderBy("mix_bucket")) - F.col("mix_words")
    offsets = counted.select("source", "mix_bucket", offset.alias("mix_offset"))
    sizes = counted.groupBy("source").agg(F.sum("mix_words").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeats).withColumn("mix_take", F.round("target").cast("long"))
    targets = materialize(
        spark, targets.withColumn("mix_blocks", F.ceil(F.col("mix_take") / block_words)), "mix-targets"
    )
    root = targets.agg(F.sort_array(F.collect_list(F.struct("mix_number", "mix_blocks"))).alias("q")).select(
        F.col("q.mix_blocks").alias("quotas")
    )
    leaves = split_quotas(root, shards, seed).select("shard", F.posexplode("quotas").alias("mix_number", "n"))
    ends = (
        leaves.withColumn("end", F.sum("n").over(W.partitionBy("mix_number").orderBy("shard")))
        .groupBy("mix_number")
        .agg(F.sort_array(F.collect_list("end")).alias("mix_ends"))
    )
    sources = materialize(spark, targets.join(ends, "mix_number").drop("mix_number", "mix_blocks"), "mix-sources")

    same = lambda other, *names: [F.col(f"d.{n}").eqNullSafe(F.col(f"{other}.{n}")) for n in names]
    kept = [F.col(f"d.{name}") for name in sized.columns]
    placed = sized.alias("d").join(small(offsets).alias("o"), same("o", "source", "mix_bucket"), "left")
    placed = placed.select(*kept, "mix_offset").alias("d")
    extra = [F.col(f"s.{name}") for name in sources.columns if name != "source"]
    placed = placed.join(small(sources).alias("s"), same("s", "source"), "left").select("d.*", *extra)
    within = W.partitionBy("source", "mix_bucket").orderBy("mix_order", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("mix_start", F.col("mix_offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    copies = ", ".join(map(str, range(max_repeats)))
    return placed.withColumn(
        "placements",
        F.expr(
            f"""filter(transform(array({copies}), e -> named_struct('copy', e,
                'words', greatest(0L, least(size, mix_take - e * source_size - mix_start)),
                'shard', size(filter(mix_ends, b -> b <= (e * source_size + mix_start) DIV {block_words})))),
                p -> p.words > 0)"""
        ),
    ).withColumn("taken", F.expr("aggregate(placements, 0L, (a, p) -> a + p.words)")).drop(
        "mix_order", "mix_bucket", "mix_offset", "mix_take", "mix_ends"
    ).withColumnRenamed("mix_start", "stream_start")


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def mixed_documents(plan: DataFrame) -> DataFrame:
    """A row for each copy that `plan` takes, its text cut to the words taken, with `copy`, `words`, `shard`."""
    copies = plan.withColumn("mix_copy", F.explode("placements")).select(
        *plan.drop("placements", "taken", "stream_start", "copy", "words", "shard").columns, "mix_copy.*"
    )
    cut = F.when(F.col("words") < F.col("size"), first_words(F.col("text"), F.col("words"))).otherwise(F.col("text"))
    return copies.withColumn("text", cut)


def whole_documents(plan: DataFrame) -> DataFrame:
    """A row for each copy that `plan` takes, its text whole, with `copy`, `words`, `shard`.

    The copy that fills a source's target is there if that brings the source nearer to it than leaving it out.
    """
    copies = plan.withColumn("mix_copy", F.explode("placements")).select(
        *plan.drop("placements", "taken", "stream_start", "copy", "words", "shard").columns, "mix_copy.*"
    )
    return copies.filter("2 * words >= size").withColumn("words", F.col("size"))


def _in_order(spark: SparkSession, hashed: DataFrame, ties: list[str], buckets: int | None) -> DataFrame:
    """`slot` of each row: its place in its shard by `mix_order`, without gaps from 0."""
    buckets = buckets or bucket_count(hashed)
    hashed = hashed.withColumn("mix_bucket", _bucket(F.col("mix_order"), buckets))
    counts = materialize(spark, hashed.groupBy("shard", "mix_bucket").agg(F.count("*").alias("n")), "mix-slots")
    before = F.sum("n").over(W.partitionBy("shard").orderBy("mix_bucket")) - F.col("n")
    within = W.partitionBy("shard", "mix_bucket").orderBy("mix_order", *ties)
    return (
        hashed.join(small(counts.select("shard", "mix_bucket", before.alias("mix_before"))), ["shard", "mix_bucket"])
        .withColumn("slot", F.col("mix_before") + F.row_number().over(within) - 1)
        .drop("mix_before", "mix_bucket", "mix_order")
    )


def local_order(spark: SparkSession, mixed: DataFrame, *, buckets: int | None = None, seed: int = 21) -> DataFrame:
    """`mixed` with `slot`: the place of each copy in its shard's permuted order, without gaps from 0."""
    hashed = mixed.withColumn(
        "mix_order",
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("source").cast("string"), F.col("text").cast("string"), "copy"),
    )
    return _in_order(spark, hashed, ["doc_id", "copy"], buckets)


def placed_in_order(spark: SparkSession, plan: DataFrame, *, buckets: int | None = None, seed: int = 21) -> DataFrame:
    """The rows of `plan` without their texts, each of their `placements` with its `slot` in the shard's local shuffle.

    A copy that is taken is named by its source and the place where it begins in that source's stream.
    """
    plan = materialize(spark, plan.drop("text"), "mix-plan")
    key = ["source", "stream_start", "copy"]
    copies = plan.select("source", "stream_start", F.explode("placements").alias("p")).select("source", "stream_start", "p.*")
    hashed = copies.withColumn("mix_order", F.xxhash64(F.lit(seed), F.col("source").cast("string"), *key[1:]))
    placed = _in_order(spark, hashed, key, buckets).groupBy("source", "stream_start").agg(
        F.sort_array(F.collect_list(F.struct("copy", "words", "shard", "slot"))).alias("mix_placed")
    )
    same = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.stream_start") == F.col("p.stream_start"))
    none = F.expr("CAST(array() AS ARRAY<STRUCT<copy: INT, words: BIGINT, shard: INT, slot: BIGINT>>)")
    kept = [F.col(f"d.`{name}`") for name in plan.columns if name != "placements"]
    # Documents that are not taken, any number of which may stand at one place, do not go into the join.
    taken, rest = plan.filter(F.size("placements") > 0).alias("d"), plan.filter(F.size("placements") == 0).alias("d")
    joined = taken.join(placed.alias("p"), same).select(*kept, F.col("mix_placed").alias("placements"))
    return joined.union(rest.select(*kept, none.alias("placements")))
