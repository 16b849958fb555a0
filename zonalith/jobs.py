"""Command line: night, measure, promote, forecast, validate. Inputs and outputs are tables that Spark reads and writes."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession, functions as F

from zonalith import constants as C, schemas
from zonalith.operators import incremental, intelligence, temporal, validation
from zonalith.plans import land_driver, pipeline
from zonalith.session import DEFAULTS, reach_workers


def measure(spark: SparkSession, a: argparse.Namespace) -> int:
    """Cells and lands to accepted observations and rejected outcomes. Exit code 2 when rows were read and none was accepted."""
    lands = spark.read.parquet(a.lands)
    if a.tenant:
        lands = lands.where(F.col("tenant_id") == a.tenant)
    rows = pipeline.measure_optical(spark.read.parquet(a.cells), lands)
    if a.dry_run:
        rows.show(20, False)
        return 0
    rows.write.mode("overwrite").parquet(f"{a.out}/all")
    good, bad = pipeline.split_outcomes(spark.read.parquet(f"{a.out}/all"))
    good.write.mode("overwrite").parquet(f"{a.out}/accepted")
    bad.write.mode("overwrite").parquet(f"{a.out}/rejected")
    n = spark.read.parquet(f"{a.out}/accepted").count()
    return 0 if n or not spark.read.parquet(f"{a.out}/all").count() else 2


def night(spark: SparkSession, a: argparse.Namespace) -> int:
    """CD2, CD11, SM8: one night over all lands. The tables are folders of `tables`: lands, scenes, cells, radar_passes, radar_cells,
    history and, once there is one, ledger. Writes accepted, rejected, radar, ledger and lands to `out`, prints the totals, and
    exits by `incremental.exit_code`: 2 in an outage, 3 when accepted rows could not be promoted."""
    read = lambda name: spark.read.parquet(f"{a.tables}/{name}")
    lands = read("lands")
    if a.tenant:
        lands = lands.where(F.col("tenant_id") == a.tenant)
    if a.dry_run:
        lands.show(20, False)
        return 0
    try:
        ledger = read("ledger")
    except AnalysisException:
        ledger = spark.createDataFrame([], schemas.LEDGER)
    as_of = F.lit(a.as_of).cast("date") if a.as_of else F.current_date()
    lookback = C.BACKFILL_DAYS if a.backfill else a.lookback
    tables = [read(t) for t in ("scenes", "cells", "radar_passes", "radar_cells")]
    done = land_driver.night(lands, *tables, ledger, read("history"), a.version, as_of, lookback, radar_mode=a.radar, reprocess=a.reprocess)
    for name, rows in done._asdict().items():
        rows.write.mode("overwrite").parquet(f"{a.out}/{name}")
    report = land_driver.totals(spark.read.parquet(f"{a.out}/lands")).first()
    accepted = spark.read.parquet(f"{a.out}/accepted")
    records = intelligence.observed(accepted.join(lands.select("land_id"), "land_id").withColumn("context", F.lit(None).cast(f"struct<{', '.join(f'{c}:double' for c in intelligence.CONTEXT)}>")))
    records.write.mode("overwrite").parquet(f"{a.out}/intelligence")
    missed = accepted.count() - spark.read.parquet(f"{a.out}/intelligence").count()
    print(json.dumps(report.asDict() | {"promotion_failed": missed}, indent=2))
    return incremental.exit_code(report["observations"], report["unchanged"], missed)


def promote(spark: SparkSession, a: argparse.Namespace) -> int:
    """CD8: observed records of stored observations, of one tenant or from a date on. Exit code 2 when rows were read and none was
    promoted."""
    rows = spark.read.parquet(a.observations)
    if a.tenant:
        rows = rows.where(F.col("tenant_id") == a.tenant)
    if a.since:
        rows = rows.where(F.col("acquisition_date") >= F.lit(a.since).cast("date"))
    if "context" not in rows.columns:
        rows = rows.withColumn("context", F.lit(None).cast(f"struct<{', '.join(f'{c}:double' for c in intelligence.CONTEXT)}>"))
    intelligence.observed(rows).write.mode("overwrite").parquet(a.out)
    read, written = rows.count(), spark.read.parquet(a.out).count()
    print(json.dumps({"source_rows_read": read, "intelligence_rows": written, "source_rows_skipped": read - written}))
    return 2 if read and not written else 0


def forecast(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = spark.read.parquet(a.observations)
    if a.tenant:
        rows = rows.where(F.col("tenant_id") == a.tenant)
    out = temporal.forecast(rows, "land_id", "acquisition_date", "ndvi_value", "quality_score", "scene_id")
    temporal.predicted_records(out, "land_id", a.model).write.mode("overwrite").parquet(a.out)
    return 0


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    """CD12: split by land, audit for leakage, bootstrap on the test lands, print JSON."""
    validation.check_reference(a.reference_source)
    pairs = validation.load_pairs(spark, a.csv)
    train, test = validation.grouped_split(pairs, "land_id", a.test_fraction)
    if not validation.leakage(train, test, "land_id").isEmpty():
        print("leakage between train and test lands", file=sys.stderr)
        return 1
    result = validation.bootstrap(test, "land_id", "native_ndvi", "estimated_ndvi", "reference_ndvi", min_pairs=a.min_pairs)
    print(json.dumps(result | {"reference_source": a.reference_source}, indent=2))
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="zonalith")
    sub = p.add_subparsers(dest="job", required=True)
    m = sub.add_parser("measure")
    m.add_argument("cells")
    m.add_argument("lands")
    m.add_argument("out")
    m.add_argument("--tenant")
    m.add_argument("--dry-run", action="store_true")
    n = sub.add_parser("night")
    n.add_argument("tables")
    n.add_argument("out")
    n.add_argument("--tenant")
    n.add_argument("--as-of")
    n.add_argument("--lookback", type=int, default=C.LOOKBACK_DAYS)
    n.add_argument("--backfill", action="store_true")
    n.add_argument("--reprocess", action="store_true")
    n.add_argument("--dry-run", action="store_true")
    n.add_argument("--radar", choices=("fallback", "always", "off"), default="fallback")
    n.add_argument("--version", default="fractional_coverage_v3")
    i = sub.add_parser("promote")
    i.add_argument("observations")
    i.add_argument("out")
    i.add_argument("--tenant")
    i.add_argument("--since")
    f = sub.add_parser("forecast")
    f.add_argument("observations")
    f.add_argument("out")
    f.add_argument("--tenant")
    f.add_argument("--model", default="linear-v1")
    v = sub.add_parser("validate")
    v.add_argument("csv")
    v.add_argument("--reference-source", required=True)
    v.add_argument("--min-pairs", type=int, default=30)
    v.add_argument("--test-fraction", type=float, default=0.2)
    a = p.parse_args(argv)
    spark = SparkSession.builder.config(map=DEFAULTS).getOrCreate()
    reach_workers(spark)
    return {"night": night, "measure": measure, "promote": promote, "forecast": forecast, "validate": validate}[a.job](spark, a)


if __name__ == "__main__":
    sys.exit(main())
