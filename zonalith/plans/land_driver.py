"""The nightly run over lands: search, dedupe, ledger, optical measurement, outliers, radar, outcomes and status, as one plan.

All lands go through each step together; scenes that are known are left out by anti-joins before any cell is read, so a
quiet night reads none. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from zonalith import constants as C, schemas
from zonalith.operators import incremental as I, temporal as T
from zonalith.plans import pipeline
from zonalith.session import staged
from zonalith.sources import scenes as S

KEYS = pipeline.KEYS


class Night(NamedTuple):
    accepted: DataFrame  # optical rows, with temporal_outlier
    rejected: DataFrame
    radar: DataFrame
    ledger: DataFrame  # rows to append
    lands: DataFrame  # schemas.LAND_REPORT


def items_of(lands: DataFrame, scenes: DataFrame, as_of: Column, lookback: int) -> tuple[DataFrame, DataFrame]:
    """(items found, one of each acquisition) of the lands with a usable boundary. scenes: land_id, scene_id, acquisition_date,
    acquired_at, cloud, contains, overlap."""
    own = lands.where("geometry_fingerprint is not null").select("land_id", "geometry_fingerprint")
    found = S.search_optical(scenes, "acquisition_date", "cloud", as_of, lookback).join(own, "land_id")
    return found, I.dedupe_tiles(found, ["land_id", "acquired_at"], "contains", "overlap", "scene_id")


def night(
    lands: DataFrame,
    scenes: DataFrame,
    cells: DataFrame,
    radar_passes: DataFrame,
    radar_cells: DataFrame,
    ledger: DataFrame,
    history: DataFrame,
    version: str,
    as_of: Column,
    lookback: int = C.LOOKBACK_DAYS,
    radar_days: int = C.RADAR_LOOKBACK_DAYS,
    radar_mode: str = "fallback",
    reprocess: bool = False,
    measure: Callable[[DataFrame, DataFrame], DataFrame] = pipeline.measure_optical,
    measure_radar: Callable[[DataFrame, DataFrame], DataFrame] = pipeline.measure_radar,
) -> Night:
    """CD2, CD11, CD3: a scene is measured unless this version has evaluated it for this boundary (`reprocess` ignores that); a
    scene without cells could not be read and is tried again another night. Radar stands in for lands without an optical
    row now or before in the window, or for all lands (`radar_mode` 'always', 'fallback' or 'off').

    lands: land_id, tenant_id, acres, geometry_confidence, buffered, geometry_fingerprint (null: no usable boundary); cells and
    radar_cells: as the measures take them; radar_passes: land_id, scene_id, acquisition_date; history: land_id, acquisition_date,
    ndvi_value; measure gives `reject_reason`, null where accepted."""
    found, items = items_of(lands, scenes, as_of, lookback)
    since = F.date_sub(as_of, max(lookback, radar_days) + 5)
    if reprocess:
        ledger = ledger.limit(0)
    known = ledger.where((F.col("pipeline_version") == version) & (F.col("acquisition_date") >= since)).groupBy(*I.LEDGER_KEY).agg(F.bool_or(F.col("outcome") == "accepted").alias("was_accepted"))
    # Written once, as each is read by several of the steps that follow.
    items = staged(items.join(known, list(I.LEDGER_KEY), "left"), "items")
    pending = items.where("was_accepted is null").select(*I.LEDGER_KEY, "acquisition_date")
    read = cells.join(pending.select(*KEYS), KEYS, "left_semi")
    measured = staged(measure(read, lands).join(pending, KEYS), "measured")
    good, rejected = pipeline.split_outcomes(measured)
    points = history.select("land_id", "acquisition_date", "ndvi_value").unionByName(good.select("land_id", "acquisition_date", "ndvi_value"))
    accepted = T.temporal_outliers(good, points, "land_id", "acquisition_date", "ndvi_value").drop("abs_delta", "ref_date")
    retry = pending.join(measured.select(*KEYS), KEYS, "left_anti")

    count = lambda df, name, *more: df.groupBy("land_id").agg(F.count("*").alias(name), *more)
    report = lands.select("land_id", F.col("geometry_fingerprint").isNull().alias("error"))
    prior = F.bool_or(F.coalesce("was_accepted", F.lit(False))).alias("prior_accepted")
    for part in (count(found, "items"), count(items, "kept", F.count("was_accepted").alias("known"), prior), count(accepted, "accepted"), count(rejected, "rejected"), count(retry, "retry")):
        report = report.join(part, "land_id", "left")
    report = report.na.fill(0).na.fill(False, ["prior_accepted"])

    report = staged(report, "report")
    wants = report.where(~F.col("error") & F.lit(radar_mode != "off"))
    if radar_mode == "fallback":
        wants = wants.where((F.col("accepted") == 0) & ~F.col("prior_accepted"))
    own = wants.select("land_id").join(lands.select("land_id", "geometry_fingerprint"), "land_id")
    passes = radar_passes.where((F.col("acquisition_date") >= F.date_sub(as_of, radar_days)) & (F.col("acquisition_date") <= as_of)).join(own, "land_id")
    newest = pipeline.newest_pass(passes).join(known, list(I.LEDGER_KEY), "left_anti").select(*I.LEDGER_KEY, "acquisition_date")
    radar = staged(measure_radar(radar_cells.join(newest.select(*KEYS), KEYS, "left_semi"), lands).join(newest, KEYS), "radar")

    report = report.join(count(radar, "radar", F.count_if(F.col("reject_reason").isNull()).alias("radar_ok")), "land_id", "left").na.fill(0)
    report = report.withColumn("n_rows", F.col("accepted") + F.col("radar_ok")).withColumn("n_optical", F.col("accepted"))
    report = I.land_status(report.withColumn("stored", F.lit(True)).withColumn("promoted", F.lit(True)))
    report = report.withColumn("deduped", F.col("items") - F.col("kept")).withColumn("pending", F.col("kept") - F.col("known"))
    cols = [*I.LEDGER_KEY, "acquisition_date", F.col("reject_reason").alias("reason")]
    done = lambda df, ok: df.where(F.col("reject_reason").isNull() if ok else F.col("reject_reason").isNotNull()).select(*cols)
    outcomes = I.ledger_outcomes(done(measured, True).unionByName(done(radar, True)), done(measured, False).unionByName(done(radar, False)), retry, version)
    return Night(accepted, rejected, radar, schemas.conform(outcomes, schemas.LEDGER), schemas.conform(report, schemas.LAND_REPORT))


def totals(lands: DataFrame) -> DataFrame:
    """SNK7 of a night, by its land report."""
    return I.run_summary(lands.withColumn("n_obs", F.col("accepted") + F.col("radar")))


def read_counters(events: DataFrame, run: str, order: str, bytes_: str, release: str, limit: int) -> DataFrame:
    """AG24: of each run the peak of reserved bytes, and how many reservations a budget of `limit` bytes denied. A denied one reserves
    nothing; a release never goes below nothing. Each step depends on the one before, so a run's events are folded in order: one
    run is one task's work, 17 bytes an event."""
    step = F.struct(F.col(order).alias("o"), F.greatest(F.col(bytes_), F.lit(0)).cast("long").alias("n"), F.col(release).alias("r"))
    g = events.groupBy(run).agg(F.sort_array(F.collect_list(step)).alias("steps"))
    zero = F.struct(F.lit(0).cast("long").alias("used"), F.lit(0).cast("long").alias("peak"), F.lit(0).cast("long").alias("denied"))

    def fold(s: Column, e: Column) -> Column:
        fits = s["used"] + e["n"] <= limit
        used = F.when(e["r"], F.greatest(s["used"] - e["n"], F.lit(0).cast("long"))).when(fits, s["used"] + e["n"]).otherwise(s["used"])
        return F.struct(used.alias("used"), F.greatest(s["peak"], used).alias("peak"), (s["denied"] + F.when(~e["r"] & ~fits, 1).otherwise(0)).alias("denied"))

    return g.select(run, F.aggregate("steps", zero, fold).alias("s")).select(run, F.col("s.peak").alias("peak_bytes"), "s.denied")
