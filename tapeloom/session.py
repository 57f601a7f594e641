"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Every instant is UTC, casts fail loudly, and a day rewrite touches only the days it holds.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Counts and extremes come from file footers where a frame is read as `sinks.snapshots.read_footers` does.
    "spark.sql.parquet.aggregatePushdown": "true",
    # The JVM never compiles methods over 8000 bytes. Stages whose generated code is larger, such
    # as the wide ticker projection, then use Spark's split projections, which it does compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Shuffle files go when the execution that made them ends. Else they stay until the driver's JVM happens to collect its
    # garbage, and a job of many steps holds those of all of them.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # State of streams lives on local disk and in the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Whole texts go to Python workers: some megabytes at a time, not ten thousand rows of any length.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(app_name: str = "tapeloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; `extra` adds or overrides settings."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings above, and let its Python workers import this package.

    The import path of the driver serves installations whose path all machines share, and local sessions; elsewhere ship the package with
    `--py-files`.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in `spark.checkpoint.dir`.

    Only a local session may fall back to a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.gettempdir()
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/tapeloom-{purpose}-{uuid.uuid4().hex}"


def materialize(spark: SparkSession, df, purpose: str):
    """Write a frame to the shared folder and read it back, so later steps see one fixed copy."""
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Remove the copy that `materialize` made, when nothing reads it any more."""
    jvm = df.sparkSession._jvm
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        if not path.getName().startswith("tapeloom-"):
            raise ValueError(f"{folder} is no scratch table")
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
