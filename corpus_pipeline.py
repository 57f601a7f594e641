"""Corpus pipeline over `documents`: each stage reads what the one before it kept.

toxicity (documents the model rejects go), near_duplicates (one document of each group stays), decontamination
(documents that hold benchmark items go), mixing (copies by source weight), sharding (shards of equal bytes).
All stages but the last return the columns of `documents`. No stage can be written as SQL but in parts.

In every stage: null and empty texts are clean, not duplicates of anything, hold no item, and have no words to mix, so
the mix takes none of them; texts of any length are read whole. Rows with a null id are judged by their text like
others and are nobody's duplicate. Of repeated rows near_duplicates leaves one, and of equally good documents the one
with the smallest id. Columns beside `doc_id`, `text` and `source` keep their values whatever their names are; only
sharding replaces columns named `size`, `shard` and `slot`, which it adds. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import decontamination, minhash_dedup, mixing, sharding, toxicity
from tapeloom.session import prepare, scratch_dir

ORACLE_SQL = None
USED = ("doc_id", "text", "source")


def with_columns_kept(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `stage` makes of `docs`, with the columns of `docs`: those it does not use bear other names meanwhile, so
    that none is taken for a column that an operator adds."""
    names = {name: name if name in USED else f"document column {i}" for i, name in enumerate(docs.columns)}
    return stage(docs.withColumnsRenamed(names)).select(*[F.col(f"`{names[name]}`").alias(name) for name in docs.columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from `labels`, does not predict to be toxic."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(spark, docs, labels)
    return with_columns_kept(docs, lambda d: toxicity.score_texts(d, model).filter("predicted = 0"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    prepare(spark)
    return with_columns_kept(docs, lambda d: minhash_dedup.drop_near_duplicates(spark, d, shingle_words=5, percent=80))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised ones included."""
    prepare(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return with_columns_kept(docs, lambda d: decontamination.mark_leaks(spark, d, benchmark).filter("not leaked"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, each whole: the last of a source where that is nearer to its target."""
    return with_columns_kept(docs, lambda d: mixing.whole_documents(mixing.mix_plan(spark, d)))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard of 8 and their place in it."""
    prepare(spark)
    return sharding.shard_documents(docs, shards=8)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; each result is stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
