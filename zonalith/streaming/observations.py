"""Structured Streaming forms of the incremental run: late data, exactly-once storage, forward-only snapshots, state.

The batch operators are reused inside foreachBatch: a batch that is run again upserts the same rows, so storage is
exactly-once whatever fails. State is bounded by the watermark, except for the previous zones, one small record a land.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from zonalith import constants as C
from zonalith.operators import incremental as I, temporal as T

DELAY_DAYS = C.LOOKBACK_DAYS + 5


def lookback(stream: DataFrame, time: str, days: int = DELAY_DAYS) -> DataFrame:
    """SM1: rows later than the lookback window are not waited for."""
    return stream.withWatermark(time, f"{days} days")


def first_sight(stream: DataFrame, time: str, keys: Sequence[str]) -> DataFrame:
    """SM2: each scene of a land once within the window."""
    return lookback(stream, time).dropDuplicatesWithinWatermark(list(keys))


def daily(stream: DataFrame, time: str, land: str, value: str) -> DataFrame:
    """Per land and day: count and mean, emitted when the watermark has passed the day."""
    return lookback(stream, time).groupBy(F.window(time, "1 day"), land).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).select(F.col("window.start").alias("day"), land, "n", "mean")


BUCKETS = 32
BUCKET = "zonalith_bucket"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a function from text to its paths."""
    jvm = spark.sparkContext._jvm
    to = lambda *x: jvm.org.apache.hadoop.fs.Path(*x)
    return to(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to


def versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """The complete versions of each bucket, newest first."""
    fs, to = _files(spark, path)
    out: dict[int, list[int]] = {}
    if not fs.exists(to(path)):
        return out
    for v in fs.listStatus(to(path)):
        if v.getPath().getName().startswith("version=") and fs.exists(to(v.getPath(), "_SUCCESS")):
            for b in fs.listStatus(v.getPath()):
                if b.getPath().getName().startswith(f"{BUCKET}="):
                    out.setdefault(int(b.getPath().getName().split("=")[1]), []).append(int(v.getPath().getName().split("=")[1]))
    return {b: sorted(found, reverse=True) for b, found in out.items()}


def current(spark: SparkSession, path: str, below: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The table as of the last complete version of each bucket (before `below`; of the given buckets)."""
    own = {b: [n for n in found if below is None or n < below] for b, found in versions(spark, path).items() if buckets is None or b in buckets}
    at = [f"{path}/version={found[0]:010d}/{BUCKET}={b}" for b, found in sorted(own.items()) if found]
    return spark.read.parquet(*at) if at else None


def _forget(spark: SparkSession, path: str, number: int) -> None:
    """Drop what neither a reader nor batch `number`, should it run again, needs: of each bucket, the newest version and the newest
    before `number` stay."""
    fs, to = _files(spark, path)
    for b, found in versions(spark, path).items():
        keep = {found[0], *[n for n in found if n < number][:1]}
        for n in set(found) - keep:
            fs.delete(to(f"{path}/version={n:010d}/{BUCKET}={b}"), True)


def _advance(path: str, keys: Sequence[str], buckets: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges a batch into the buckets its keys fall in. Batch n writes version n of those only, from the
    versions before n, so a batch that runs again writes the same. A reader has its files until the second batch after."""
    deal = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            touched = [r[0] for r in batch.select(deal.alias("b")).distinct().collect()]
            if not touched:
                return
            before = current(batch.sparkSession, path, number, touched)
            merged = merge(batch.limit(0) if before is None else before, batch)
            merged.withColumn(BUCKET, deal).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/version={number:010d}")
            _forget(batch.sparkSession, path, number)
        finally:
            batch.unpersist()

    return write


def upsert_sink(path: str, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """SM2, SNK1: foreachBatch function that merges a batch into a Parquet table of buckets by key. The number of buckets belongs to
    the table and must not change."""
    return _advance(path, keys, buckets, lambda before, batch: I.merge_upsert(before, batch, keys, order))


def snapshot_sink(path: str, key: str, date: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """SM4: foreachBatch function that moves each land's snapshot forward only; its table is as that of upsert_sink."""
    return _advance(path, [key], buckets, lambda before, batch: I.snapshot_forward(before, batch, key, date))


def flag_outliers(batch: DataFrame, history: DataFrame, land: str, date: str, value: str) -> DataFrame:
    """SM6: stream-static: rows of a batch against the stored history and each other."""
    cols = [land, date, value]
    return T.temporal_outliers(batch, history.select(*cols).unionByName(batch.select(*cols)), land, date, value)


def persistent_zones(stream: DataFrame, land: str, time: str, weakest: str, level: str) -> DataFrame:
    """SM5: a quarter that was weakest at the previous pass, too, turns `watch` into `check`. State: one record of each land."""
    kind = stream.schema[land].dataType.simpleString()

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("t", kind="stable")
        last = state.get if state.exists else (None, None, None)
        out = []
        for t, w, lv in zip(rows["t"], rows["w"], rows["level"], strict=True):
            moment = t.value
            if last[2] is not None and moment < last[2]:
                out.append((key[0], t, w, lv))  # late: stored as it is, state does not go back
                continue
            again = lv == "watch" and last[1] in ("watch", "check") and last[0] == w
            now = "check" if again else lv
            out.append((key[0], t, w, now))
            last = (w, now, moment)
        state.update(last)
        yield pd.DataFrame(out, columns=["k", "t", "w", "level"])

    own = stream.select(F.col(land).alias("k"), F.col(time).alias("t"), F.col(weakest).alias("w"), F.col(level).alias("level"))
    return own.groupBy("k").applyInPandasWithState(step, f"k {kind}, t timestamp, w string, level string", "w string, level string, t long", "append", GroupStateTimeout.NoTimeout)


def new_scenes(batch: DataFrame, ledger: DataFrame, version: str, since: Column) -> DataFrame:
    """SM2-SM3 inside foreachBatch: what this version has not evaluated."""
    return I.unseen(batch, ledger, version, since)


def bounded_source(spark: SparkSession, path: str, schema, files: int = 8, name: str | None = None) -> DataFrame:
    """SM7: a file stream that takes a bounded number of files a trigger; name: only files of this name (a glob)."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return (reader if name is None else reader.option("pathGlobFilter", name)).parquet(path)
