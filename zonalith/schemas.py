"""CD15: declared schemas of the result records, as DDL. `conform` gives a frame exactly these columns, missing ones as NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

OBSERVATION = """land_id long, scene_id string, tenant_id string, acquisition_date date, ndvi_value double, ndvi_spatial_std double,
effective_pixel_count double, coverage_weighted_purity double, ndvi_spatial_se double, ndvi_lower_95 double, ndvi_upper_95 double,
quality_score double, confidence_score double, confidence_level string, measurement_status string, evidence_confidence string,
spatial_stat_method string, temporal_outlier boolean"""
RADAR = """land_id long, scene_id string, tenant_id string, acquisition_date date, rvi_mean double, rvi_std double, cross_ratio_db double,
vv_db double, vh_db double, epc double, quality_score double, confidence_score double, confidence_level string, reject_reason string"""
LEDGER = "land_id long, scene_id string, geometry_fingerprint string, acquisition_date date, pipeline_version string, outcome string, reason string"
LAND_REPORT = """land_id long, items long, deduped long, known long, pending long, accepted long, rejected long, retry long, radar long,
prior_accepted boolean, status string, snapshot boolean"""


def conform(df: DataFrame, ddl: str) -> DataFrame:
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl)])
