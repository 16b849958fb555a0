"""Map projection, grouping keys, image grids, colours, paths and dates as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from zonalith import constants as C

# WGS84 and the UTM scale.
_A, _F, _K0 = 6378137.0, 1 / 298.257223563, 0.9996


def utm_zone(lon: Column) -> Column:
    """PRJ18."""
    return (F.floor((lon + 180.0) / 6.0) + 1).cast("int")


def utm_epsg(lat: Column, lon: Column) -> Column:
    return (F.when(lat >= 0, 32600).otherwise(32700) + utm_zone(lon)).cast("int")


def utm(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Easting and northing by the transverse Mercator series in the third flattening, to its third order."""
    n = _F / (2 - _F)
    radius = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - (utm_zone(lon) * 6 - 183))
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east = eta
    north = xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500000.0 + _K0 * radius * east, F.when(lat < 0, 10000000.0).otherwise(0.0) + _K0 * radius * north


def spatial_group_key(lat: Column, lon: Column, fallback_lat: Column | None = None, fallback_lon: Column | None = None) -> Column:
    """PRJ19: utm<zone><N|S>:<100 km east>:<100 km north>; NULL off the grid."""
    if fallback_lat is not None:
        whole = lat.isNotNull() & lon.isNotNull()
        lat, lon = F.when(whole, lat).otherwise(fallback_lat), F.when(whole, lon).otherwise(fallback_lon)
    e, n = utm(lat, lon)
    cell = lambda x: F.floor(x / C.SPATIAL_GROUP_CELL_M).cast("string")
    key = F.concat(F.lit("utm"), utm_zone(lon).cast("string"), F.when(lat >= 0, "N").otherwise("S"), F.lit(":"), cell(e), F.lit(":"), cell(n))
    return F.when(lat.between(-80.0, 84.0) & lon.between(-180.0, 180.0), key)


def fingerprint(rings: Column, digits: int = 7) -> Column:
    """PRJ20: 16 hex digits of a canonical text of the snapped coordinates; rings are arrays of (x, y)."""
    snapped = lambda x: F.call_function("format_number", x, F.lit(f"0.{'0' * digits}"))
    point = lambda p: F.concat_ws(" ", snapped(p["x"]), snapped(p["y"]))
    text = F.array_join(F.transform(rings, lambda r: F.array_join(F.transform(r, point), ",")), ";")
    return F.substring(F.sha1(text.cast("binary")), 1, 16)


def bounding_cells(width_m: Column, height_m: Column, cell_m: float = 10.0) -> Column:
    """GE12."""
    return ((F.ceil(width_m / cell_m) + 1) * (F.ceil(height_m / cell_m) + 1)).cast("long")


def image_grid(width_deg: Column, height_deg: Column, lat: Column, most: int = 512, least: int = 64) -> Column:
    """PRJ35: struct(w, h) in pixels, the longer side `most`, aspect by the cosine of the latitude."""
    wide = width_deg * F.cos(F.radians(lat))
    ratio = wide / height_deg
    w = F.when(ratio >= 1, float(most)).otherwise(most * ratio)
    h = F.when(ratio >= 1, most / ratio).otherwise(float(most))
    size = lambda x: F.greatest(F.lit(least), F.round(x).cast("int"))
    return F.struct(size(w).alias("w"), size(h).alias("h"))


def ramp_color(value: Column, stops: tuple = C.COLOR_STOPS, entries: int = 512) -> Column:
    """PRJ33: struct(r, g, b): clamp, nearest of `entries` steps, linear between stops."""
    lo, hi = stops[0][0], stops[-1][0]
    v = F.greatest(F.lit(lo), F.least(F.lit(hi), F.coalesce(value, F.lit(lo))))
    step = F.bround((v - lo) / (hi - lo) * (entries - 1), 0)
    x = lo + step * ((hi - lo) / (entries - 1))

    def channel(k: int) -> Column:
        rgb = [int(h[1 + 2 * k : 3 + 2 * k], 16) for _, h in stops]
        out = F.lit(float(rgb[-1]))
        for j in range(len(stops) - 2, -1, -1):
            (a, _), (b, _) = stops[j], stops[j + 1]
            out = F.when(x <= b, rgb[j] + (x - a) / (b - a) * (rgb[j + 1] - rgb[j])).otherwise(out)
        return F.bround(out, 0).cast("int")

    return F.struct(*[channel(k).alias(n) for k, n in enumerate("rgb")])


def stretch(v: Column, p2: Column, p98: Column) -> Column:
    """PRJ36: 2-98 % stretch to 0..1; a flat channel is 0."""
    return F.when(p98 > p2, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - p2) / (p98 - p2)))).otherwise(0.0)


def zone_class(v: Column, median: Column, gap: float = 0.05) -> Column:
    """PRJ34: 1 below, 2 near, 3 above the median."""
    return F.when(v < median - gap, 1).when(v > median + gap, 3).when(v.isNotNull(), 2)


def image_path(tenant: Column, land: Column, day: Column, scene: Column, suffix: str = "") -> Column:
    """SNK12: tenant/land/date_scene[suffix].png with every character that is no letter, digit, _ or - replaced."""
    clean = F.regexp_replace(scene, r"[^\p{L}\p{N}_-]", "_")
    return F.concat(tenant, F.lit("/"), land, F.lit("/"), F.date_format(day, "yyyy-MM-dd"), F.lit("_"), clean, F.lit(f"{suffix}.png"))


def parse_date(text: Column) -> Column:
    """PRJ37: an ISO time, else the date of the first ten characters, else NULL."""
    return F.coalesce(F.to_date(F.try_to_timestamp(text)), F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")).cast("date"))
