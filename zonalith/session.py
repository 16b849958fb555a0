"""Session helpers: shared staging folder, worker import path, default settings."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_own_dir: str | None = None


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").config(map=DEFAULTS)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    builder = builder.config("spark.driver.memory", memory).config("spark.ui.enabled", "false")
    return builder.config("spark.ui.showConsoleProgress", "false").getOrCreate()


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers of this application import the package from where the driver did."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([root, *parts])


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Fewer rows in an Arrow batch, for what runs inside: workers with much of their own to hold need the room."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a local one where that is unset and Spark is local."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="zonalith-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return f"file://{_own_dir}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/zonalith/{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage: write df once to the shared folder and read it back."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files behind a staged frame that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
