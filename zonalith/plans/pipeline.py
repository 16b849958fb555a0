"""The measurement pipeline composed of operators: cells to observations, zones, water layers and records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from zonalith.functions import evidence as E, spectral as S
from zonalith.operators import intelligence, stats

KEYS = ["land_id", "scene_id"]


def measure_optical(cells: DataFrame, lands: DataFrame) -> DataFrame:
    """CD1: one graded observation of each land and scene. cells: land_id, scene_id, row, col, coverage, scl and reflectance bands;
    lands: land_id, tenant_id, acres, geometry_confidence, buffered."""
    bands = {b: F.col(b) for b in ("b02", "b03", "b04", "b05", "b08", "b8a", "b11") if b in cells.columns}
    made = S.indices(bands)
    own = cells.withColumn("w", stats.suppress_slivers(F.col("coverage"))).withColumns({n.lower(): stats.crop_mask(x, F.col("scl")) for n, x in made.items()})
    masks = stats.mask_fractions(own, KEYS, "scl", "w")
    ndvi = stats.weighted_stats(own, KEYS, "ndvi", "w")
    mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col("w")), F.sum(F.when(F.col(c).isNotNull(), F.col("w")))).alias(f"{c}_value")
    others = own.groupBy(*KEYS).agg(*[mean(n.lower()) for n in made if n != "NDVI"])
    j = masks.join(ndvi, KEYS, "left").join(others, KEYS, "left").join(lands, "land_id")
    a = E.assess(
        epc_valid=F.coalesce(F.when(F.col("epc") != 0, F.col("epc")), F.col("epc_crop")),
        epc_total=F.col("epc_total"),
        valid_px=F.col("n_crop_pixels"),
        field_px=F.col("n_field_pixels"),
        cloud=F.col("cloud_fraction"),
        shadow=F.col("shadow_fraction"),
        snow=F.col("snow_fraction"),
        purity=F.col("purity"),
        interior_epc=F.col("interior_epc"),
        buffered=F.col("buffered"),
        acres=F.col("acres"),
        geometry=F.col("geometry_confidence"),
    )
    bounds = S.bounds_95(F.col("mean"), F.col("se"))
    return j.withColumn("a", a).select(
        *KEYS,
        "tenant_id",
        F.round("mean", 4).alias("ndvi_value"),
        *[F.round(f"{n.lower()}_value", 4).alias(f"{n.lower()}_value") for n in made if n != "NDVI"],
        F.round("std", 4).alias("ndvi_spatial_std"),
        F.round("epc", 4).alias("effective_pixel_count"),
        F.round("purity", 4).alias("coverage_weighted_purity"),
        F.round("se", 6).alias("ndvi_spatial_se"),
        F.round(bounds["low"], 4).alias("ndvi_lower_95"),
        F.round(bounds["high"], 4).alias("ndvi_upper_95"),
        F.col("a.quality").alias("quality_score"),
        F.col("a.confidence").alias("confidence_score"),
        F.col("a.level").alias("confidence_level"),
        F.col("a.status").alias("measurement_status"),
        F.col("a.evidence").alias("evidence_confidence"),
        F.col("a.reject_reason").alias("reject_reason"),
        F.lit("fractional_coverage_v3").alias("spatial_stat_method"),
    )


def measure_radar(cells: DataFrame, lands: DataFrame) -> DataFrame:
    """CD3: one radar row of each land and scene, apart from every optical value; rejected ones carry the reason."""
    s = stats.radar_stats(cells, KEYS, "vv", "vh", "coverage").join(lands, "land_id")
    tier = E.evidence_tier(F.col("epc"), F.lit(None).cast("double"))
    q = E.radar_quality(F.col("epc"), F.col("acres"), F.col("geometry_confidence"), tier["confidence"])
    return s.select(*KEYS, "tenant_id", F.lit(None).cast("double").alias("ndvi_value"), *[F.round(c, 4).alias(c) for c in ("rvi_mean", "rvi_std", "cross_ratio_db", "vv_db", "vh_db", "epc")], q["quality"].alias("quality_score"), q["confidence"].alias("confidence_score"), q["level"].alias("confidence_level"), E.radar_gate(F.col("epc"), F.col("n")).alias("reject_reason"))


def newest_pass(passes: DataFrame) -> DataFrame:
    """JN5: the newest pass of each land, ties by scene. passes: land_id, scene_id, acquisition_date."""
    newest = F.row_number().over(Window.partitionBy("land_id").orderBy(F.col("acquisition_date").desc_nulls_last(), "scene_id"))
    return passes.withColumn("back", newest).where("back = 1").drop("back")


def split_outcomes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows."""
    return rows.where("reject_reason is null"), rows.where("reject_reason is not null")


def enrich_context(observations: DataFrame, ring: DataFrame) -> DataFrame:
    """CD4: neighbour context beside each observation, which stays as it is. ring: land_id, scene_id, median, mad, n_cells, tier."""
    j = observations.join(ring, KEYS, "left")
    d = E.context_delta(F.col("ndvi_value"), F.col("median"), F.col("mad"), F.col("n_cells"), F.col("ndvi_spatial_se"), F.col("tier"))
    ctx = F.struct(F.col("median").alias("context_ndvi_mean"), F.col("median").alias("context_ndvi_median"), d["delta"].alias("parcel_context_delta"), d["z"].alias("parcel_context_robust_z"))
    return j.withColumn("context", ctx).drop(*[c for c in ring.columns if c not in KEYS])


def promote(observations: DataFrame) -> DataFrame:
    """CD8."""
    return intelligence.observed(observations)


def observe(cells: DataFrame, lands: DataFrame, ring: DataFrame, scenes: DataFrame) -> DataFrame:
    """CD1, CD4, CD8: cells measured and split; accepted rows get context and are promoted, rejected ones keep their reason.
    scenes: scene_id, acquisition_date."""
    good, bad = split_outcomes(measure_optical(cells, lands))
    own = enrich_context(good, ring).join(scenes, "scene_id", "left")
    record = promote(own).select(*KEYS, "observed_ndvi", "parcel_context_delta", "parcel_context_robust_z", "evidence.context_present", "intelligence_status")
    accepted = own.select(*good.columns, "acquisition_date").join(record, KEYS, "left").withColumn("outcome", F.lit("accepted"))
    return accepted.unionByName(bad.withColumn("outcome", F.lit("rejected")), allowMissingColumns=True)
