"""Spectral indices and scalar measurement math as Column expressions. Missing is NULL, never NaN or zero."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from zonalith import constants as C


def finite(x: Column) -> Column:
    """NaN and infinities become NULL: the boundary rule of every operator."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def safe_round(x: Column, digits: int) -> Column:
    """PRJ15: rounded, NULL when not a finite number; text is tried as a number."""
    return F.round(finite(x.try_cast("double")), digits)


def nd(a: Column, b: Column) -> Column:
    """PRJ1: (a-b)/(a+b) where the sum exceeds EPS."""
    return F.when(a + b > C.EPS, (a - b) / (a + b))


def guarded_ratio(a: Column, b: Column) -> Column:
    """PRJ2: the water variant, which guards the size of the sum."""
    return F.when(F.abs(a + b) > C.EPS, (a - b) / (a + b))


def savi(n: Column, r: Column) -> Column:
    """PRJ5."""
    return F.when(n + r > C.EPS, 1.5 * (n - r) / (n + r + 0.5))


def evi(n: Column, r: Column, b: Column) -> Column:
    """PRJ6."""
    den = n + 6.0 * r - 7.5 * b + 1.0
    return F.when(F.abs(den) > C.EPS, 2.5 * (n - r) / den)


def mcari(re: Column, r: Column, g: Column) -> Column:
    """PRJ7: clipped to -1..5, needs red above 0.01."""
    value = ((re - r) - 0.2 * (re - g)) * re / r
    return F.when(r > 0.01, F.greatest(F.lit(-1.0), F.least(F.lit(5.0), value)))


#: Index name to its expression over named bands.
INDICES = {
    "NDVI": (("b08", "b04"), lambda b: nd(b["b08"], b["b04"])),
    "SAVI": (("b08", "b04"), lambda b: savi(b["b08"], b["b04"])),
    "EVI": (("b08", "b04", "b02"), lambda b: evi(b["b08"], b["b04"], b["b02"])),
    "NDRE": (("b8a", "b05"), lambda b: nd(b["b8a"], b["b05"])),
    "MCARI": (("b05", "b04", "b03"), lambda b: mcari(b["b05"], b["b04"], b["b03"])),
    "NDMI": (("b08", "b11"), lambda b: nd(b["b08"], b["b11"])),
    "NDWI": (("b03", "b08"), lambda b: nd(b["b03"], b["b08"])),
    "MNDWI": (("b03", "b11"), lambda b: nd(b["b03"], b["b11"])),
}


def indices(bands: Mapping[str, Column]) -> dict[str, Column]:
    """PRJ3, PRJ4, PRJ8: every index whose bands are there, valid only where NDVI is."""
    out: dict[str, Column] = {}
    ndvi = INDICES["NDVI"][1](bands) if {"b08", "b04"} <= set(bands) else None
    for name, (needs, make) in INDICES.items():
        if set(needs) <= set(bands):
            value = make(bands)
            out[name] = value if name == "NDVI" or ndvi is None else F.when(ndvi.isNotNull(), value)
    return out


def index_validity(name: str, value: Column) -> Column:
    """PRJ9: struct(ok, reason)."""
    lo, hi = C.INDEX_BOUNDS[name]
    reason = F.when(value.isNull(), "null").when(F.isnan(value) | (F.abs(value) == float("inf")), "non_finite").when((value < lo) | (value > hi), F.lit(f"out_of_range[{lo},{hi}]"))
    return F.struct(reason.isNull().alias("ok"), F.coalesce(reason, F.lit("ok")).alias("reason"))


def scale_offset(asset_scale: Column, asset_offset: Column, baseline: Column) -> Column:
    """PRJ10: struct(scale, offset, source): asset metadata where it has either value, else the processing baseline's rule
    (4.0 and later: -1000 counts), else the default. A scale that is not positive or an offset that is not finite is an error."""
    found = asset_scale.isNotNull() | asset_offset.isNotNull()
    scale = F.coalesce(asset_scale.try_cast("double"), F.lit(0.0001))
    scale = F.when((scale <= 0) | F.isnan(scale) | (scale == float("inf")), F.raise_error(F.lit("invalid reflectance scale"))).otherwise(scale)
    late = ~found & F.coalesce(baseline.try_cast("double") >= 4.0, F.lit(False))
    offset = F.coalesce(asset_offset.try_cast("double"), F.when(late, -1000.0 * scale).otherwise(0.0))
    offset = F.when(F.isnan(offset) | (F.abs(offset) == float("inf")), F.raise_error(F.lit("invalid reflectance offset"))).otherwise(offset)
    source = F.when(found, "stac_raster_bands").when(late, "esa_boa_add_offset_fallback").otherwise("sentinel2_default")
    return F.struct(scale.alias("scale"), offset.alias("offset"), source.alias("source"))


def reflectance(dn: Column, scale: Column, offset: Column) -> Column:
    """PRJ11: in FLOAT, as the bands are; NULL below 0 and above the maximum."""
    value = dn.cast("float") * scale.cast("float") + offset.cast("float")
    return F.when((value >= F.lit(0.0).cast("float")) & (value <= F.lit(C.REFLECTANCE_MAX).cast("float")), value)


def calibration(asset_scale: Column, asset_offset: Column, baseline: Column) -> Column:
    """PRJ12: provenance of the calibration of a band."""
    so = scale_offset(asset_scale, asset_offset, baseline)
    return F.struct(so["scale"].alias("scale"), so["offset"].alias("offset"), so["source"].alias("source"), baseline.try_cast("double").alias("baseline"), F.lit("physical = raw * scale + offset").alias("formula"))


def radar(vv: Column, vh: Column) -> Column:
    """PRJ13: struct(rvi, cross_ratio) of linear backscatter; NULL unless both are positive."""
    ok = (vv > 0) & (vh > 0)
    rvi = F.greatest(F.lit(0.0), F.least(F.lit(2.0), 4.0 * vh / (vv + vh + C.EPS)))
    return F.struct(F.when(ok, rvi).alias("rvi"), F.when(ok, vh / (vv + C.EPS)).alias("cross_ratio"))


def decibel(x: Column) -> Column:
    """PRJ14: of an average, never before averaging."""
    return 10.0 * F.log10(x + C.EPS)


def coverage_area_error(epc: Column, area_m2: Column) -> Column:
    """PRJ16."""
    return F.when(area_m2 > 0, F.abs(epc * C.PIXEL_AREA_M2 - area_m2) / area_m2).otherwise(0.0)


def bounds_95(mean: Column, se: Column) -> Column:
    """PRJ17: struct(low, high, provable): the last is the smallest change that can be shown between two passes."""
    return F.struct((mean - 1.96 * se).alias("low"), (mean + 1.96 * se).alias("high"), (2.0 * 2.0**0.5 * se).alias("provable"))
