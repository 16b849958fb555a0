"""Sharding by a two-pass external shuffle.

Pass one scatters rows uniformly into memory-sized buckets by a seeded hash of id and text; pass two sorts each bucket
into a canonical order, shuffles it by Fisher-Yates under a generator seeded with (seed, bucket) and writes it. Buckets
laid end to end are one uniform permutation; shards are its equal runs, so their row counts differ by at most one.

Defined results: null ids and texts are hashed as such (a null text is the size of an empty one); repeated rows share a
bucket; an empty table gives an empty result; other columns pass through, those named
`shard` or `slot` with `in_` before; very long texts are rows like others.

Scale: the buckets' counts, one number each, come to the driver (bytes / bucket_bytes of them); rows are moved once. A
task holds one bucket. A lost task's bucket is rebuilt to the same order, since that depends on the rows alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from zonalith.llm import words as W
from zonalith.session import new_path, reach_workers

BUCKET_BYTES = 32 << 20
ROW_BYTES = 64


def _emit(pending: list, offsets: np.ndarray, total: int, shards: int, seed: int, names: list[str]):
    table = pa.Table.from_batches(pending)
    bucket = table.column("bucket")[0].as_py()
    table = table.take(pc.sort_indices(table, [("h", "ascending"), ("g", "ascending")]))
    order = np.random.Generator(np.random.PCG64(np.random.SeedSequence([seed, bucket]))).permutation(len(table))
    position = int(offsets[bucket]) + np.arange(len(table), dtype=np.int64)
    shard = position * shards // total
    first = -(-shard * total // shards)
    step = 2048
    for lo in range(0, len(order), step):
        part = table.select(names[:-2]).take(pa.array(order[lo : lo + step]))
        columns = [c.combine_chunks() for c in part.columns]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        columns += [pa.array(shard[lo : lo + step].astype(np.int32)), pa.array((position - first)[lo : lo + step])]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def external_shuffle(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """df in shuffled order with `shard` (int) and `slot` (long, gapless from 0) last."""
    reach_workers(df.sparkSession)
    inner = [f"c{k}" for k in range(len(df.columns))]
    own = df.toDF(*inner)
    key = [F.col(inner[df.columns.index(c)]) for c in (id_col, text_col)]
    own = own.withColumn("h", F.xxhash64(F.lit(seed), *key)).withColumn("g", F.xxhash64(F.lit(~seed), *key))
    rows, size = own.select(F.count("*"), F.sum(F.coalesce(F.octet_length(key[1]), F.lit(0)) + ROW_BYTES)).first()
    buckets = max(1, math.ceil((size or 0) / bucket_bytes))
    own = own.withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    counts = np.zeros(buckets + 1, dtype=np.int64)
    for bucket, n in own.groupBy("bucket").count().collect():
        counts[bucket + 1] = n
    offsets = np.cumsum(counts)
    names = [*inner, "shard", "slot"]

    def shuffle(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for b in pc.unique(batch.column("bucket")).to_pylist():
                held.setdefault(b, []).append(batch.filter(pc.equal(batch.column("bucket"), b)))
        for b in sorted(held):
            yield from _emit(held.pop(b), offsets, rows, shards, seed, names)

    schema = StructType([own.schema[c] for c in inner]).add("shard", "integer").add("slot", "long")
    out = own.repartitionById(buckets, F.col("bucket")).mapInArrow(shuffle, schema)
    given: list[str] = []
    for c in df.columns:
        clash = c.lower() in ("shard", "slot")
        given.append(W.free(f"in_{c}", [*df.columns, *given]) if clash else c)
    return out.toDF(*given, "shard", "slot")


def write_shards(shuffled: DataFrame) -> DataFrame:
    """Write the shuffled rows as Parquet, a folder for each shard, and give the table that reads them back."""
    spark = shuffled.sparkSession
    path = new_path(spark, "shards")
    shuffled.write.partitionBy("shard").parquet(path)
    return spark.read.schema(shuffled.schema).parquet(path)
