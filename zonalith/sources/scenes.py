"""Scene tables: search, acquisition metadata, CRS and layer configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonalith import constants as C


def search_optical(scenes: DataFrame, date: str, cloud: str, end: Column, days: int = C.LOOKBACK_DAYS) -> DataFrame:
    """SRC5, FLT1: scenes of [end - days, end], opaque ones dropped, unknown cloud kept."""
    near = (F.col(date) >= F.date_sub(end, days)) & (F.col(date) <= end)
    return scenes.where(near & (F.coalesce(F.col(cloud), F.lit(0.0)) <= C.SCENE_CLOUD_REJECT_ABOVE))


def meets(scene: str, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """SRC5, SRC6: whether a scene's box (a struct x0, y0, x1, y1) meets the given one; a scene without a box may be anywhere."""
    b = F.col(scene)
    apart = (b["x0"] > x1) | (b["x1"] < x0) | (b["y0"] > y1) | (b["y1"] < y0)
    return ~F.coalesce(apart, F.lit(False))


def search_radar(scenes: DataFrame, area: str, collection: str, mode: str, assets: str, preference: tuple[str, ...]) -> DataFrame:
    """SRC6: wide-swath scenes with both polarisations; of each area the first collection in preference that has any."""
    has = lambda name: F.exists(F.map_keys(assets), lambda k: F.lower(k) == name)
    own = scenes.where((F.col(mode) == "IW") & has("vv") & has("vh"))
    order = F.lit(len(preference))
    for k in range(len(preference) - 1, -1, -1):
        order = F.when(F.col(collection) == preference[k], k).otherwise(order)
    best = F.min("pref").over(Window.partitionBy(area))
    return own.withColumn("pref", order).withColumn("best", best).where("pref = best").drop("pref", "best")


def newest_first(scenes: DataFrame, time: str) -> DataFrame:
    """SO2."""
    return scenes.orderBy(F.col(time).desc_nulls_last())


def tile_of(properties: Column) -> Column:
    """SRC7."""
    return F.coalesce(properties["s2:mgrs_tile"], properties["grid:code"])


def resolve_crs(candidates: list[Column]) -> Column:
    """SRC11: the first known of raster, asset and item; none is an error."""
    return F.coalesce(*candidates, F.raise_error(F.lit("no CRS in raster, asset or item")).cast("string"))


def with_config(rows: DataFrame, config: DataFrame, key: str, value: str) -> DataFrame:
    """SRC17, JN16: enabled configuration by code; a miss is an error."""
    cfg = config.where("enabled").select(key, value)
    miss = F.raise_error(F.concat(F.lit("no enabled configuration for "), F.col(key).cast("string"))).cast(config.schema[value].dataType)
    return rows.join(cfg, key, "left").withColumn(value, F.when(F.col(value).isNotNull(), F.col(value)).otherwise(miss))
