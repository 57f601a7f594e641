"""Sharding by sampled splitters: shards of nearly equal bytes, equal texts side by side.

1. Rows are ordered by a hash of the text, then a hash of the id: equal texts are neighbours.
2. A sample is drawn with chances in proportion to weight (by hash, so reruns agree), and its quantiles are
   the boundaries of ranges. A row weighs half its share of all bytes and half its share of all rows, so that
   neither a few long texts nor very many empty ones fill a range. The sample grows with the number of
   ranges, one per `range_rows` rows, and holds `draws` keys for each: at most some megabytes at the driver.
3. A text drawn for one boundary keeps its copies together: the boundary stands before the first of them.
   A text drawn for several weighs a whole range by itself and is subdivided by the hash of the id.
4. The weight of each range is added up. Ranges that came out over twice the mean are sampled again inside
   and subdivided.
5. Sums over ranges, and a window within a range, place every row on the line of all bytes; shard
   boundaries cut this line into equal parts. Copies of one text whose bytes are under `together` of a
   shard go to one shard as a whole.

Null texts have no bytes and size 1. Very long texts are rows like others and are read for their hash and length.
Null ids, ties and repeated rows are ordered by hash and id; rows of equal id and text are interchangeable and
stay in one range. Other columns are kept, but for those beginning with `cut_` and those named as the
columns that are added, which are replaced. Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

LEAST_RANGES = 64
SMALLEST = np.iinfo(np.int64).min


def _range_of(splitters: np.ndarray):
    """The range of (text hash, id hash): how many splitters are not above it."""
    texts, ids = np.ascontiguousarray(splitters[:, 0]), np.ascontiguousarray(splitters[:, 1])

    @F.pandas_udf("int")
    def place(text: pd.Series, doc: pd.Series) -> pd.Series:
        text, doc = text.to_numpy(), doc.to_numpy()
        low, high = np.searchsorted(texts, text, "left"), np.searchsorted(texts, text, "right")
        at = low.copy()
        split = np.flatnonzero(high > low)
        for begin in np.unique(low[split]):
            rows = split[low[split] == begin]
            at[rows] = begin + np.searchsorted(ids[begin : high[rows[0]]], doc[rows], "right")
        return pd.Series(at.astype(np.int32))

    return place


def _sample(keyed: DataFrame, draws: float) -> np.ndarray:
    """About `draws` keys of all rows, drawn in proportion to weight; a row over 1 / draws is drawn several times."""
    expected = F.col("cut_weight") * F.lit(float(draws))
    chance = F.pmod(F.xxhash64(F.lit(9), "cut_text", "cut_doc"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = F.floor(expected + chance).cast("int")
    rows = keyed.select("cut_text", "cut_doc", times.alias("times")).filter("times > 0").toPandas()
    keys = np.repeat(rows[["cut_text", "cut_doc"]].to_numpy(dtype=np.int64).reshape(-1, 2), rows["times"].to_numpy(dtype=np.int64), axis=0)
    return keys[np.lexsort((keys[:, 1], keys[:, 0]))]


def _quantiles(sample: np.ndarray, parts: int) -> np.ndarray:
    """`parts` - 1 boundaries, each in front of its text's copies unless the text holds several of them."""
    if not len(sample) or parts < 2:
        return np.zeros((0, 2), dtype=np.int64)
    cuts = sample[[len(sample) * i // parts for i in range(1, parts)]].copy()
    texts, times = np.unique(cuts[:, 0], return_counts=True)
    cuts[np.isin(cuts[:, 0], texts[times == 1]), 1] = SMALLEST
    return np.unique(cuts, axis=0)


def _splitters(keyed: DataFrame, rows: int, range_rows: int, draws: int) -> np.ndarray:
    ranges = max(LEAST_RANGES, -(-rows // range_rows))
    splitters = _quantiles(_sample(keyed, ranges * draws), ranges)
    filled = keyed.groupBy(_range_of(splitters)("cut_text", "cut_doc").alias("r")).agg(F.sum("cut_weight").alias("w"))
    overfull = {row.r: row.w for row in filled.filter(F.col("w") > 2 / ranges).collect()}
    if overfull:
        inside = keyed.filter(_range_of(splitters)("cut_text", "cut_doc").isin(list(overfull)))
        sample = _sample(inside, ranges * draws)
        place = np.array([tuple(k) for k in sample], dtype="i8,i8")
        at = np.searchsorted(np.array([tuple(k) for k in splitters], dtype="i8,i8"), place, "right")
        more = [_quantiles(sample[at == r], int(np.ceil(weight * ranges))) for r, weight in overfull.items()]
        splitters = np.unique(np.concatenate([splitters, *more]), axis=0)
    return splitters


def shard_documents(
    docs: DataFrame, *, shards: int = 8, range_rows: int = 1_000_000, draws: int = 32, together: float = 0.02
) -> DataFrame:
    """`docs` (`doc_id`, `text`, others) with `size` (UTF-8 bytes + 1), `shard` and `slot` (from 0, no gaps)."""
    docs = docs.drop("size", "shard", "slot")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns(
        {
            "size": F.octet_length(text).cast("long") + 1,
            "cut_text": F.xxhash64(text),
            "cut_doc": F.xxhash64(F.lit(1), F.col("doc_id").cast("string")),
        }
    )
    rows, total = keyed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    weight = (F.col("size") / F.lit(float(max(total, 1))) + F.lit(1.0 / max(rows, 1))) / 2
    keyed = keyed.withColumn("cut_weight", weight)
    place = _range_of(_splitters(keyed, rows, range_rows, draws) if rows else np.zeros((0, 2), dtype=np.int64))
    ranged = keyed.withColumn("cut_range", place("cut_text", "cut_doc"))
    sums = ranged.groupBy("cut_range").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    line = W.partitionBy(F.lit(1)).orderBy("cut_range")
    offsets = sums.select(
        "cut_range",
        (F.sum("b").over(line) - F.col("b")).alias("cut_bytes"),
        (F.sum("n").over(line) - F.col("n")).alias("cut_rows"),
    )
    within = W.partitionBy("cut_range").orderBy("cut_text", "cut_doc", "doc_id")
    before = within.rowsBetween(W.unboundedPreceding, -1)
    copies = W.partitionBy("cut_range", "cut_text")
    placed = (
        ranged.join(offsets, "cut_range")
        .withColumns(
            {
                "cut_bytes": F.col("cut_bytes") + F.coalesce(F.sum("size").over(before), F.lit(0)),
                "cut_rows": F.col("cut_rows") + F.row_number().over(within) - 1,
            }
        )
        .withColumns({"cut_group": F.sum("size").over(copies), "cut_first": F.min("cut_bytes").over(copies)})
    )
    whole = F.col("cut_group") * shards <= F.lit(together * total)
    twice = F.when(whole, 2 * F.col("cut_first") + F.col("cut_group")).otherwise(2 * F.col("cut_bytes") + F.col("size"))
    shard = F.least(F.lit(shards - 1), F.floor(twice * shards / F.lit(2.0 * max(total, 1)))).cast("int")
    placed = placed.withColumn("shard", shard)
    begins = placed.groupBy("shard").agg(F.min("cut_rows").alias("cut_begin"))
    return (
        placed.join(F.broadcast(begins), "shard")  # one row per shard
        .withColumn("slot", F.col("cut_rows") - F.col("cut_begin"))
        .select(*docs.columns, "size", "shard", "slot")
    )
