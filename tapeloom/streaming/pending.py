"""Facts that met no terms yet: kept beside a stream, joined again in later micro-batches.

Layout: <root>/after=<load label>/*.parquet holds what waits after a micro-batch. A micro-batch reads what the one before
it left and writes a directory of its own, so a repeated micro-batch starts from the same rows and replaces its own
outcome. States that no repetition can need are removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeloom import schemas
from tapeloom.operators.enrichment import attach_terms
from tapeloom.session import materialize

_FOUND = "met_terms"


def _states(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """(query, micro-batch) of the kept states, ascending by micro-batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path) if status.isDirectory()]
    labels = [name.removeprefix("after=").rpartition("-") for name in names if name.startswith("after=")]
    return sorted(((query, int(number)) for query, _, number in labels), key=lambda state: state[1])


def _place(root: str, query: str, number: int) -> str:
    return f"{root.rstrip('/')}/after={query}-{number}"


def _remove(spark: SparkSession, location: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def settle(
    facts: DataFrame,
    instruments: DataFrame,
    root: str,
    label: str,
    give_up_ms: int | None = None,
    keys: Sequence[str] = ("instrument_name",),
) -> DataFrame:
    """Facts of a micro-batch and those that waited, with their terms; what still has none waits below `root`.

    `label` is the load label of the micro-batch (`sinks.events.each_batch`). With `give_up_ms`, facts received that long
    before the newest one are returned without terms. Every fact is returned exactly once over the life of the stream,
    if `release` returns the last ones.
    """
    spark = facts.sparkSession
    query, _, number = label.rpartition("-")
    earlier = [n for q, n in _states(spark, root) if q == query and n < int(number)]
    everything = facts
    if earlier:
        everything = facts.unionByName(spark.read.schema(facts.schema).parquet(_place(root, query, earlier[-1])))
    known = instruments.withColumn(_FOUND, F.lit(True))
    joined = materialize(spark, attach_terms(everything, known, keys, extra=(_FOUND,)), "settled")
    waits = F.col(_FOUND).isNull()
    if give_up_ms is not None:
        newest = joined.agg(F.max("received_mts").alias("newest")).first()["newest"]
        waits = waits & (F.col("received_mts") > F.lit((newest or 0) - give_up_ms))
    left = joined.where(waits).select(*facts.columns)
    left.write.mode("overwrite").options(**schemas.PARQUET_OPTIONS).parquet(_place(root, query, int(number)))
    for old in earlier[:-1]:  # the last but one can still be asked for
        _remove(spark, _place(root, query, old))
    return joined.where(~waits).drop(_FOUND)


def release(spark: SparkSession, root: str, instruments: DataFrame, schema, keys: Sequence[str] = ("instrument_name",)) -> DataFrame:
    """All facts that wait below `root` after the last micro-batch of each query, with terms where they exist by now.

    `schema` is that of the facts. Store the result, then call `forget`; until then the states stay.
    """
    newest = dict(_states(spark, root))
    places = [_place(root, query, number) for query, number in newest.items()]
    waiting = spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)
    return attach_terms(waiting, instruments, keys)


def forget(spark: SparkSession, root: str) -> None:
    """Remove all states below `root`; a stream that goes on starts without waiting facts."""
    for query, number in _states(spark, root):
        _remove(spark, _place(root, query, number))
