"""Observed-intelligence records: a promotion of stored observations, which never adds a value."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonalith.functions.spectral import finite

CONTEXT = ("context_ndvi_mean", "context_ndvi_median", "parcel_context_delta", "parcel_context_robust_z")


def observed(rows: DataFrame) -> DataFrame:
    """PRJ31: one record of each row with tenant, land, scene and a finite value; missing context stays missing.
    rows: tenant_id, land_id, scene_id, ndvi_value, acquisition_date, quality_score, and a struct `context`."""
    value = finite(F.col("ndvi_value").cast("double"))
    context = [finite(F.col(f"context.{c}")).alias(c) for c in CONTEXT]
    present = F.col("context.context_ndvi_mean").isNotNull()
    own = rows.where(F.col("tenant_id").isNotNull() & F.col("land_id").isNotNull() & F.col("scene_id").isNotNull() & value.isNotNull())
    return own.select(
        "tenant_id",
        "land_id",
        "scene_id",
        "acquisition_date",
        value.alias("observed_ndvi"),
        F.lit(None).cast("double").alias("estimated_ndvi"),
        *context,
        F.struct(finite(F.col("quality_score").cast("double")).alias("measurement_quality"), F.lit("observed measurement/context evidence; no predictive model").alias("scope")).alias("uncertainty"),
        F.struct(F.lit("observed").alias("observed_or_predicted"), F.coalesce(present, F.lit(False)).alias("context_present")).alias("evidence"),
        F.struct(F.lit("ndvi_data").alias("source"), F.col("scene_id").alias("scene_id"), F.lit(False).alias("model_inference")).alias("provenance"),
        F.lit("observed_context").alias("intelligence_status"),
        F.lit("not_applicable_observed").alias("validation_status"),
        F.lit("observed").alias("observed_or_predicted"),
    )
