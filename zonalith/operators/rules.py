"""Constraints, tenant scope, decision-grade selection and schema alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def violations(df: DataFrame, rules: dict[str, Column], row_id: str) -> DataFrame:
    """FLT8: (row id, rule) of every broken rule; NULL passes, as in SQL."""
    items = F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(~c, F.lit(False)).alias("broken")) for n, c in rules.items()])
    return df.select(row_id, F.explode(items).alias("x")).where("x.broken").select(row_id, "x.rule")


def support_plausible(method: Column, epc: Column, area_m2: Column, total_px: Column, mixed: Column) -> Column:
    """The method-aware bound on spatial support."""
    no_area = area_m2.isNull() | (area_m2 <= 0)
    v3 = epc.isNull() | no_area | (epc * 100.0 <= area_m2 * 1.02 + 100.0)
    v2 = total_px.isNull() | no_area | (total_px <= F.ceil(area_m2 / 100.0 * 1.25) + 2) | F.coalesce(mixed, F.lit(False))
    return F.when(method == "fractional_coverage_v3", v3).when(method == "pixel_mask_v2_2", v2).otherwise(True)


def stat_method(version: Column, scene: Column) -> Column:
    """The backfilled method of rows that carry none."""
    return F.when(version.like("v3%"), "fractional_coverage_v3").when(version.like("v2.2%"), "pixel_mask_v2_2").when(scene.isNotNull(), "pixel_mask_v2_1").otherwise("legacy_v1")


def decision_grade(df: DataFrame, as_of: Column, land: str, date: str, tie: str, value: str, quality: str, observed: Column, epc: Column | None = None, low: Column | None = None, over_count: Column | None = None) -> DataFrame:
    """FLT7, WN1, WN11: rows a decision may use, with age, freshness and recency rank. as_of is a parameter."""
    keep = observed & F.col(value).isNotNull() & (F.col(quality) >= 0.55)
    if epc is not None:
        keep = keep & (epc.isNull() | (epc >= 3.0))
    if low is not None:
        keep = keep & (F.coalesce(low, F.lit(1.0)) != 0)
    if over_count is not None:
        keep = keep & ~F.coalesce(over_count, F.lit(False))
    age = F.date_diff(as_of, F.col(date))
    order = Window.partitionBy(land).orderBy(F.col(date).desc(), F.col(tie).desc())
    return df.where(keep).withColumn("age_days", age).withColumn("is_fresh", age <= 14).withColumn("recency_rank", F.row_number().over(order))


def tenant_scope(df: DataFrame, tenants: DataFrame, key: str) -> DataFrame:
    """FLT9: rows of the tenants that may be seen; the list is matched by a semi-join and may be of any size."""
    return df.join(tenants.select(key), key, "left_semi")


def path_tenant(path: Column) -> Column:
    """The tenant of an image path, when its first segment has the form of an id."""
    first = F.element_at(F.split(path, "/"), 1)
    return F.when(first.rlike("^[0-9a-fA-F-]{36}$"), first)


def align_to_schema(df: DataFrame, target: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """SNK9: the columns the target knows, and the names of those left out; an unknown (empty) target filters nothing."""
    if not target:
        return df, []
    return df.select(*[c for c in df.columns if c in target]), [c for c in df.columns if c not in target]
