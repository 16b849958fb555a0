"""Accuracy against independent references: metrics, paired comparison, clustered bootstrap, grouped split, leakage."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonalith.functions.spectral import finite
from zonalith.session import reach_workers

DEPENDENT_SOURCES = ("sentinel-2", "ndvi_data", "native")


def check_reference(source: str | None) -> None:
    """FLT12: refuse a reference that is not independent."""
    if not source or source in DEPENDENT_SOURCES:
        raise ValueError("reference_source must be an independent higher-resolution or field reference")


def load_pairs(spark: SparkSession, path: str) -> DataFrame:
    """SRC12: a CSV with a header, its numbers as finite doubles or NULL."""
    df = spark.read.option("header", True).csv(path)
    return df.select(*[finite(F.col(c).try_cast("double")).alias(c) if c.endswith("_ndvi") else F.col(c) for c in df.columns])


def metrics(df: DataFrame, keys: Sequence[str], pred: str, ref: str) -> DataFrame:
    """AG12: n, MAE, RMSE, bias, R2 (NULL without variance), shares within 0.05 and 0.10."""
    e, y = F.col(pred) - F.col(ref), F.col(ref)
    spread = F.var_pop(y) * F.count(y)
    return df.where(F.col(pred).isNotNull() & y.isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(e).alias("bias"),
        F.when(spread > 1e-12, 1.0 - F.sum(e * e) / spread).alias("r2"),
        F.avg(F.when(F.abs(e) <= 0.05, 1.0).otherwise(0.0)).alias("within_005"),
        F.avg(F.when(F.abs(e) <= 0.10, 1.0).otherwise(0.0)).alias("within_010"),
    )


def paired(df: DataFrame, native: str, estimate: str, reference: str, min_pairs: int = 30, keys: Sequence[str] = ()) -> DataFrame:
    """AG13: both errors on the same pairs, the mean improvement and the share of pairs where the estimate is better."""
    a, b = F.abs(F.col(native) - F.col(reference)), F.abs(F.col(estimate) - F.col(reference))
    own = df.where(F.col(native).isNotNull() & F.col(estimate).isNotNull() & F.col(reference).isNotNull())
    return own.groupBy(*keys).agg(
        F.when(F.count("*") >= min_pairs, "evaluated").otherwise("insufficient_reference_pairs").alias("status"),
        F.count("*").alias("n_pairs"),
        F.avg(a).alias("native_mae"),
        F.avg(b).alias("estimated_mae"),
        F.avg(a - b).alias("improvement"),
        F.avg(F.when(b < a, 1.0).otherwise(0.0)).alias("fraction_better"),
    )


def cluster_errors(df: DataFrame, land: str, native: str, estimate: str, reference: str) -> DataFrame:
    """Per land: pairs and summed absolute errors; a resampled land needs no more."""
    own = df.where(F.col(land).isNotNull() & F.col(native).isNotNull() & F.col(estimate).isNotNull() & F.col(reference).isNotNull())
    return own.groupBy(F.col(land).alias("land")).agg(F.count("*").alias("n"), F.sum(F.abs(F.col(native) - F.col(reference))).alias("native_error"), F.sum(F.abs(F.col(estimate) - F.col(reference))).alias("estimated_error"))


LANDS_A_BLOCK = 50_000


def bootstrap(df: DataFrame, land: str, native: str, estimate: str, reference: str, min_pairs: int = 30, min_lands: int = 10, resamples: int = 2000, seed: int = 42, block: int = LANDS_A_BLOCK) -> dict:
    """AG14: land-clustered bootstrap of the MAE difference. Lands are reduced to three sums each and dealt to blocks of about
    `block` lands by their hash; a replicate draws how many of its lands fall in each block, then the lands inside each block, which
    together is a draw of all lands with replacement. Only the blocks' sizes and the interval reach the driver. Streams are seeded by
    replicate and block, so reruns agree."""
    spark = df.sparkSession
    reach_workers(spark)
    lands = cluster_errors(df, land, native, estimate, reference)
    whole = lands.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("k"), F.sum("native_error").alias("a"), F.sum("estimated_error").alias("b")).first()
    n, k = whole["n"], whole["k"]
    head = {"n_pairs": n, "n_lands": k, "min_pairs": min_pairs, "min_lands": min_lands, "bootstrap_unit": "land_id"}
    if n < min_pairs or k < min_lands:
        return head | {"status": "insufficient_reference_pairs_or_lands", "supported": False}
    blocks = -(-k // block)
    dealt = lands.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "land"), F.lit(blocks)).cast("int"))
    found = dict(dealt.groupBy("block").count().toLocalIterator())
    sizes = np.array([found.get(b, 0) for b in range(blocks)])
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks)
    here = spark.sparkContext.broadcast(sizes)

    def draw(key: tuple, t: pa.Table) -> pa.Table:
        b, part = key[0].as_py(), key[1].as_py()
        t = t.sort_by("land")
        table = np.column_stack([t.column(c).to_numpy() for c in ("n", "native_error", "estimated_error")]).astype(float)
        own = np.arange(part, resamples, parts)
        out = np.zeros((len(own), 3))
        for at, i in enumerate(own):
            times = np.random.default_rng([seed, int(i)]).multinomial(k, here.value / k)[b]
            out[at] = table[np.random.default_rng([seed, int(i), b]).integers(0, len(table), times)].sum(axis=0)
        return pa.table({"i": own, "n": out[:, 0], "a": out[:, 1], "b": out[:, 2]})

    copies = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    sums = copies.groupBy("block", "part").applyInArrow(draw, "i long, n double, a double, b double").groupBy("i").agg(((F.sum("a") - F.sum("b")) / F.sum("n")).alias("d"))
    lo, hi = sums.agg(F.percentile("d", 0.025), F.percentile("d", 0.975)).first()
    a, b = whole["a"] / n, whole["b"] / n
    return head | {"status": "evaluated", "native_mae": a, "estimated_mae": b, "mae_improvement_native_minus_estimated": a - b, "ci95_lower": lo, "ci95_upper": hi, "supported": bool(lo > 0)}


def grouped_split(df: DataFrame, land: str, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """ST6: train and test by land: the share of lands with the smallest seeded MD5 is the test side; rows without a land train."""
    lands = df.where(F.col(land).isNotNull()).select(land).distinct()
    k = lands.count()
    rank = F.md5(F.concat(F.lit(f"{seed}:"), F.col(land).cast("string")))
    test = lands.orderBy(rank, land).limit(max(1, round(k * test_fraction)) if k else 0)
    return df.join(test, land, "left_anti"), df.join(test, land, "left_semi")


def leakage(train: DataFrame, test: DataFrame, land: str) -> DataFrame:
    """ST3: lands on both sides."""
    return train.select(land).where(F.col(land).isNotNull()).intersect(test.select(land))


def better(native: Column, estimate: Column, reference: Column) -> Column:
    return F.abs(estimate - reference) < F.abs(native - reference)
