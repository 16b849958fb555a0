"""Queries over cells: indices, statistics, masks, quality, radar, zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonalith.functions import evidence as E, spectral as S
from zonalith.operators import stats, zones
from zonalith.plans import bindings as B
from zonalith.plans.catalog import query


def rounded(df: DataFrame, keys: list[str], digits: int = 6) -> DataFrame:
    return df.select(*keys, *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes if c not in keys])


@query(
    f"""WITH {B.CELLS_SQL} SELECT l_orderkey, l_partkey, c,
  round(CASE WHEN a + b > 1e-6 THEN (a - b) / (a + b) END, 8) AS nd,
  round(CASE WHEN abs(a + b) > 1e-6 THEN (a - b) / (a + b) END, 8) AS guarded,
  round(CASE WHEN a + b > 1e-6 THEN 1.5 * (a - b) / (a + b + 0.5) END, 8) AS savi,
  round(CASE WHEN abs(a + 6.0 * b - 7.5 * g + 1.0) > 1e-6 THEN 2.5 * (a - b) / (a + 6.0 * b - 7.5 * g + 1.0) END, 8) AS evi,
  round(CASE WHEN b > 0.01 THEN greatest(-1.0, least(5.0, ((a - b) - 0.2 * (a - g)) * a / b)) END, 8) AS mcari
FROM cells"""
)
def spectral_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1, PRJ2, PRJ5-PRJ7."""
    a, b, g = F.col("a"), F.col("b"), F.col("g")
    made = {"nd": S.nd(a, b), "guarded": S.guarded_ratio(a, b), "savi": S.savi(a, b), "evi": S.evi(a, b, g), "mcari": S.mcari(a, b, g)}
    return B.cells(spark, sf_dir).select("l_orderkey", "l_partkey", "c", *[F.round(x, 8).alias(n) for n, x in made.items()])


@query(
    f"""WITH {B.CELLS_SQL} SELECT field, scene, count(ndvi) AS n_ndvi, count(ndwi) AS n_ndwi, round(avg(ndvi), 6) AS ndvi, round(avg(ndwi), 6) AS ndwi, round(avg(ndmi), 6) AS ndmi
FROM (SELECT field, scene, CASE WHEN a + b > 1e-6 THEN (a - b) / (a + b) END AS ndvi,
  CASE WHEN a + b > 1e-6 AND g + a > 1e-6 THEN (g - a) / (g + a) END AS ndwi,
  CASE WHEN a + b > 1e-6 AND a + b + g > 1e-6 THEN (a - (b + g)) / (a + (b + g)) END AS ndmi FROM cells) t GROUP BY field, scene"""
)
def index_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ3, PRJ4, PRJ8: all indices of the bands at hand, valid where NDVI is; NDRE and MCARI are skipped without their bands."""
    made = S.indices({"b08": F.col("a"), "b04": F.col("b"), "b03": F.col("g"), "b11": F.col("b") + F.col("g")})
    assert "NDRE" not in made and "MCARI" not in made
    own = B.cells(spark, sf_dir).select("field", "scene", *[x.alias(n.lower()) for n, x in made.items()])
    mean = lambda c: F.round(F.avg(c), 6).alias(c)
    return own.groupBy("field", "scene").agg(F.count("ndvi").alias("n_ndvi"), F.count("ndwi").alias("n_ndwi"), mean("ndvi"), mean("ndwi"), mean("ndmi"))


@query(
    """SELECT reason, count(*) AS n FROM (SELECT CASE WHEN v IS NULL THEN 'null' WHEN v < -1 OR v > 1 THEN 'out_of_range[-1.0,1.0]' ELSE 'ok' END AS reason
FROM (SELECT CASE WHEN l_linenumber <> 3 THEN (l_quantity - 25) / 20.0 END AS v FROM lineitem) t) u GROUP BY reason"""
)
def index_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ9."""
    v = F.when(F.col("l_linenumber") != 3, (F.col("l_quantity") - 25) / 20.0)
    li = B.table(spark, sf_dir, "lineitem").select(S.index_validity("NDVI", v)["reason"].alias("reason"))
    return li.groupBy("reason").agg(F.count("*").alias("n"))


@query(
    """SELECT l_orderkey, l_partkey, source, round(CASE WHEN x >= 0 AND x <= CAST(1.2 AS FLOAT) THEN CAST(x AS DOUBLE) END, 5) AS reflectance
FROM (SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag = 'A' THEN 'stac_raster_bands' WHEN l_returnflag = 'N' THEN 'esa_boa_add_offset_fallback' ELSE 'sentinel2_default' END AS source,
  CAST(CAST(floor(l_extendedprice / 5) AS INT) AS FLOAT) * CAST(0.0001 AS FLOAT) + CAST(CASE WHEN l_returnflag = 'A' THEN -0.05 WHEN l_returnflag = 'N' THEN -0.1 ELSE 0.0 END AS FLOAT) AS x FROM lineitem) t"""
)
def reflectance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ10-PRJ12: counts to reflectance, scale and offset from asset metadata, baseline or default."""
    flag = F.col("l_returnflag")
    cal = S.calibration(F.lit(None).cast("string"), F.when(flag == "A", "-0.05"), F.when(flag == "N", "05.12").when(flag == "R", "03.01"))
    li = B.table(spark, sf_dir, "lineitem").withColumn("cal", cal).withColumn("dn", F.floor(F.col("l_extendedprice") / 5).cast("int"))
    out = S.reflectance(F.col("dn"), F.col("cal.scale"), F.col("cal.offset"))
    return li.select("l_orderkey", "l_partkey", F.col("cal.source").alias("source"), F.round(out.cast("double"), 5).alias("reflectance"))


WEIGHTED = """, good AS (SELECT field, scene, v, w FROM ndvi WHERE v IS NOT NULL AND w > 0),
o AS (SELECT *, (sum(w) OVER (PARTITION BY field, scene ORDER BY v, w ROWS UNBOUNDED PRECEDING) - w / 2) / sum(w) OVER (PARTITION BY field, scene) AS q,
  row_number() OVER (PARTITION BY field, scene ORDER BY v, w) AS rn, sum(v * w) OVER (PARTITION BY field, scene) / sum(w) OVER (PARTITION BY field, scene) AS m FROM good),
l AS (SELECT *, lead(v) OVER (PARTITION BY field, scene ORDER BY v, w, rn) AS nv, lead(q) OVER (PARTITION BY field, scene ORDER BY v, w, rn) AS nq FROM o),
s AS (SELECT field, scene, max(m) AS mean, sqrt(sum(w * (v - m) * (v - m)) / sum(w)) AS std, sum(w) AS epc, count(*) AS n_cells, min(v) AS lo, max(v) AS hi,
  coalesce(sum(CASE WHEN w >= 0.99 THEN w END), 0.0) AS interior_epc, sum(w * w) AS w2,
  coalesce(max(CASE WHEN q <= 0.1 AND 0.1 < nq THEN v + (nv - v) * (0.1 - q) / (nq - q) END), min(CASE WHEN rn = 1 AND q > 0.1 THEN v END), max(CASE WHEN nq IS NULL AND q <= 0.1 THEN v END)) AS p10,
  coalesce(max(CASE WHEN q <= 0.5 AND 0.5 < nq THEN v + (nv - v) * (0.5 - q) / (nq - q) END), min(CASE WHEN rn = 1 AND q > 0.5 THEN v END), max(CASE WHEN nq IS NULL AND q <= 0.5 THEN v END)) AS median,
  coalesce(max(CASE WHEN q <= 0.9 AND 0.9 < nq THEN v + (nv - v) * (0.9 - q) / (nq - q) END), min(CASE WHEN rn = 1 AND q > 0.9 THEN v END), max(CASE WHEN nq IS NULL AND q <= 0.9 THEN v END)) AS p90
  FROM l GROUP BY field, scene)"""


@query(
    f"""WITH {B.CELLS_SQL} {WEIGHTED} SELECT field, scene, round(mean, 8) AS mean, round(std, 8) AS std, round(p10, 8) AS p10, round(median, 8) AS median, round(p90, 8) AS p90,
  round(lo, 8) AS min, round(hi, 8) AS max, round(epc, 8) AS epc, n_cells, round(interior_epc, 8) AS interior_epc, round(CASE WHEN abs(mean) > 1e-6 THEN std / abs(mean) END, 8) AS cv,
  round(epc / n_cells, 8) AS purity, round(interior_epc / epc, 8) AS interior_share, round(1.0 - interior_epc / epc, 8) AS boundary_share,
  round(epc * epc / w2, 8) AS n_eff, round(std / sqrt(epc * epc / w2), 8) AS se FROM s"""
)
def weighted_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG2, WN3, WN4: the flagship."""
    return rounded(stats.weighted_stats(B.ndvi(spark, sf_dir), ["field", "scene"], "v", "w"), ["field", "scene"], 8)


@query(
    f"""WITH {B.CELLS_SQL} {WEIGHTED} SELECT field, scene, CASE WHEN interior_epc >= 10 THEN 'OBSERVED_STRONG' WHEN interior_epc >= 3 THEN 'OBSERVED_WEAK' ELSE 'INSUFFICIENT_SPATIAL_SUPPORT' END AS status,
  CASE WHEN interior_epc >= 10 THEN 'real' WHEN interior_epc >= 3 THEN 'indicative' ELSE 'too_small' END AS tier,
  round(mean - 1.96 * std / sqrt(epc * epc / w2), 8) AS low, round(mean + 1.96 * std / sqrt(epc * epc / w2), 8) AS high,
  round(2.0 * sqrt(2.0) * (std / sqrt(epc * epc / w2)), 8) AS provable, round(CASE WHEN epc > 0 THEN abs(epc * 100 - n_cells * 60.0) / (n_cells * 60.0) ELSE 0.0 END, 8) AS area_error FROM s"""
)
def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ16, PRJ17, PRJ27 on AG2: one graded row of each field and scene."""
    s = stats.weighted_stats(B.ndvi(spark, sf_dir), ["field", "scene"], "v", "w")
    t, b = E.clean_pixel_tier(F.col("interior_epc")), S.bounds_95(F.col("mean"), F.col("se"))
    return s.select("field", "scene", t["status"].alias("status"), t["tier"].alias("tier"), *[F.round(b[n], 8).alias(n) for n in ("low", "high", "provable")], F.round(S.coverage_area_error(F.col("epc"), F.col("n_cells") * 60.0), 8).alias("area_error"))


@query(
    f"""WITH {B.CELLS_SQL} SELECT field, scene, round(avg(v), 8) AS mean, round(median(v), 8) AS median, round(min(v), 8) AS min, round(max(v), 8) AS max, round(stddev_pop(v), 8) AS std,
  round(quantile_cont(v, 0.1), 8) AS p10, round(quantile_cont(v, 0.9), 8) AS p90, count(v) AS n, round(stddev_pop(v) / (abs(avg(v)) + 1e-6), 8) AS cv FROM ndvi WHERE v IS NOT NULL GROUP BY field, scene"""
)
def unweighted_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG1."""
    return rounded(stats.unweighted_stats(B.ndvi(spark, sf_dir), ["field", "scene"], "v"), ["field", "scene"], 8)


EDGES = "[" + ", ".join(repr(-1.0 + 2.0 * k / 20) for k in range(21)) + "]"
HIST = f"""h AS (SELECT field, least(len(list_filter({EDGES}, lambda e: e <= v)), 20) - 1 AS bin, sum(w) AS n FROM ndvi WHERE v BETWEEN -1 AND 1 AND w > 0 GROUP BY 1, 2),
dense AS (SELECT f.field, CAST(k.k AS INT) AS bin, coalesce(h.n, 0.0) AS n FROM (SELECT DISTINCT field FROM h) f CROSS JOIN range(20) k(k) LEFT JOIN h ON h.field = f.field AND h.bin = k.k)"""


@query(f"WITH {B.CELLS_SQL}, {HIST} SELECT field, bin, round(n, 6) AS count FROM dense")
def weighted_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG3."""
    h = stats.weighted_histogram(B.ndvi(spark, sf_dir), ["field"], "v", "w")
    return h.select("field", F.col("bin").cast("int").alias("bin"), F.round("count", 6).alias("count"))


@query(
    f"""WITH {B.CELLS_SQL}, {HIST}, m AS (SELECT field, bin, n, CAST(-0.95 + bin * 0.1 AS DOUBLE) AS mid, sum(n) OVER (PARTITION BY field) AS total, sum(n) OVER (PARTITION BY field ORDER BY bin) AS run FROM dense),
g AS (SELECT field, max(total) AS total, sum(mid * n) / max(total) AS mean, min(CASE WHEN run >= total * 0.1 THEN mid END) AS p10, min(CASE WHEN run >= total * 0.5 THEN mid END) AS p50, min(CASE WHEN run >= total * 0.9 THEN mid END) AS p90 FROM m GROUP BY field)
SELECT g.field, round(max(g.mean), 4) AS mean, round(sqrt(sum(n * (mid - mean) * (mid - mean)) / max(g.total)), 4) AS std, round(max(p10), 4) AS p10, round(max(p50), 4) AS p50, round(max(p90), 4) AS p90 FROM g JOIN m ON g.field = m.field GROUP BY g.field"""
)
def histogram_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG4."""
    h = stats.histogram_struct(stats.weighted_histogram(B.ndvi(spark, sf_dir), ["field"], "v", "w"), ["field"])
    s = h.select("field", stats.histogram_stats(F.col("histogram")).alias("s"))
    return s.select("field", *[F.col(f"s.{c}").alias(c) for c in ("mean", "std", "p10", "p50", "p90")])


MASKS = """m AS (SELECT field, scene, w, CASE WHEN scl IN (8, 9, 10) THEN 'cloud' WHEN scl IN (2, 3) THEN 'shadow' WHEN scl = 6 THEN 'water' WHEN scl = 1 THEN 'saturated' WHEN scl = 11 THEN 'snow' WHEN scl IN (4, 5) THEN 'crop' ELSE 'unaccounted' END AS k, scl FROM (SELECT field, scene, scl, CASE WHEN w > 0 AND scl <> 0 THEN w END AS w FROM cells) x)"""
CLASSES = ("cloud", "shadow", "water", "saturated", "snow", "crop", "unaccounted")
SHARES = ", ".join(f"coalesce(sum(CASE WHEN k = '{n}' THEN w END) / sum(w), 0.0) AS {n}_fraction" for n in CLASSES) + ", coalesce(sum(CASE WHEN scl = 2 THEN w END) / sum(w), 0.0) AS dark_fraction"


@query(
    f"""WITH {B.CELLS_SQL}, {MASKS}, t AS (SELECT field, scene, {SHARES}, count(w) AS n_field_pixels, count(w) FILTER (WHERE k = 'crop') AS n_crop_pixels, coalesce(sum(w), 0.0) AS epc_total, coalesce(sum(CASE WHEN k = 'crop' THEN w END), 0.0) AS epc_crop FROM m GROUP BY field, scene)
SELECT field, scene, {", ".join(f"round({n}_fraction, 6) AS {n}_fraction" for n in (*CLASSES, "dark"))}, n_field_pixels, n_crop_pixels, round(epc_total, 6) AS epc_total, round(epc_crop, 6) AS epc_crop FROM t"""
)
def mask_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT3, AG5."""
    return rounded(stats.mask_fractions(B.cells(spark, sf_dir), ["field", "scene"], "scl", "w"), ["field", "scene"])


@query(
    f"""WITH {B.CELLS_SQL} SELECT scene, count(v) AS n_all, count(CASE WHEN scl IN (4, 5) THEN v END) AS n_crop, round(avg(CASE WHEN scl IN (4, 5) THEN v END), 6) AS crop_mean,
  round(sum(CASE WHEN w * 0.03 < 0.005 THEN 0.0 ELSE w * 0.03 END), 4) AS kept_weight FROM ndvi GROUP BY scene"""
)
def crop_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2, FLT4, FLT10."""
    m = stats.crop_mask(F.col("v"), F.col("scl"))
    return B.ndvi(spark, sf_dir).groupBy("scene").agg(F.count("v").alias("n_all"), F.count(m).alias("n_crop"), F.round(F.avg(m), 6).alias("crop_mean"), F.round(F.sum(stats.suppress_slivers(F.col("w") * 0.03)), 4).alias("kept_weight"))


@query(
    f"""WITH {B.CELLS_SQL}, r AS (SELECT field, scene, w, a AS vv, b AS vh, greatest(0.0, least(2.0, 4.0 * b / (a + b + 1e-6))) AS rvi, b / (a + 1e-6) AS cr FROM cells WHERE a > 0 AND b > 0 AND w > 0),
m AS (SELECT *, sum(rvi * w) OVER (PARTITION BY field, scene) / sum(w) OVER (PARTITION BY field, scene) AS mm FROM r)
SELECT field, scene, round(sum(rvi * w) / sum(w), 6) AS rvi_mean, round(sqrt(sum(w * (rvi - mm) * (rvi - mm)) / sum(w)), 6) AS rvi_std, round(10.0 * log10(sum(cr * w) / sum(w) + 1e-6), 6) AS cross_ratio_db,
  round(10.0 * log10(sum(vv * w) / sum(w) + 1e-6), 6) AS vv_db, round(10.0 * log10(sum(vh * w) / sum(w) + 1e-6), 6) AS vh_db, count(*) AS n, round(sum(w), 6) AS epc FROM m GROUP BY field, scene"""
)
def radar_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ13, PRJ14, AG6."""
    return rounded(stats.radar_stats(B.cells(spark, sf_dir), ["field", "scene"], "a", "b", "w"), ["field", "scene"])


RADAR_Q = """q AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS epc, l_discount * 10 AS acres, CAST(l_linenumber * 3 AS BIGINT) AS px,
 CASE l_returnflag WHEN 'A' THEN 'high' WHEN 'N' THEN 'medium' ELSE 'low' END AS geom, CASE WHEN l_linestatus = 'O' THEN 'low' ELSE 'high' END AS ev FROM lineitem),
c AS (SELECT *, round(0.5 * least(epc / 50.0, 1.0), 3) AS quality, 0.5 * least(epc / 50.0, 1.0) * 0.70 * CASE WHEN acres < 0.25 THEN 0.65 ELSE 1.0 END * CASE geom WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.85 ELSE 0.55 END * CASE WHEN ev = 'low' THEN 0.75 ELSE 1.0 END AS c0 FROM q),
d AS (SELECT *, greatest(least(c0, quality - 1e-3), 0.0) AS conf FROM c)"""


@query(
    f"""WITH {RADAR_Q} SELECT l_orderkey, l_partkey, l_linenumber, quality, conf >= 0.2495 AS usable,
  CASE WHEN epc < 3 THEN 'EPC ' || printf('%.2f', epc) || ' < 3.0' WHEN px < 8 THEN 'valid_pixels ' || CAST(px AS VARCHAR) || ' < 8' END AS gate FROM d"""
)
def radar_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ30, FLT6."""
    li = B.table(spark, sf_dir, "lineitem")
    geom = F.when(F.col("l_returnflag") == "A", "high").when(F.col("l_returnflag") == "N", "medium").otherwise("low")
    q = E.radar_quality(F.col("l_quantity"), F.col("l_discount") * 10, geom, F.when(F.col("l_linestatus") == "O", "low").otherwise("high"))
    return li.select("l_orderkey", "l_partkey", "l_linenumber", q["quality"].alias("quality"), (q["level"] != "low").alias("usable"), E.radar_gate(F.col("l_quantity"), (F.col("l_linenumber") * 3).cast("long")).alias("gate"))


@query(
    """WITH t AS (SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 4.0 END AS epc, CASE WHEN l_linenumber = 6 THEN NULL ELSE l_discount * 10 END AS purity FROM lineitem),
b AS (SELECT *, CASE WHEN epc >= 8 THEN 0 WHEN epc >= 5 THEN 1 WHEN epc >= 3 THEN 2 ELSE 3 END AS b0 FROM t),
d AS (SELECT *, CASE WHEN purity < 0.6 THEN least(b0 + 1, 2) ELSE b0 END AS b1 FROM b)
SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN epc IS NULL THEN 'UNKNOWN_SPATIAL_SUPPORT' ELSE (['OBSERVED_STRONG', 'OBSERVED_LIMITED', 'OBSERVED_WEAK', 'INSUFFICIENT_SPATIAL_SUPPORT'])[b1 + 1] END AS status,
  CASE WHEN epc IS NULL THEN 'low' ELSE (['high', 'medium', 'low', 'insufficient'])[b1 + 1] END AS confidence FROM d"""
)
def evidence_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ28."""
    li = B.table(spark, sf_dir, "lineitem")
    t = E.evidence_tier(F.when(F.col("l_linenumber") != 7, F.col("l_quantity") / 4.0), F.when(F.col("l_linenumber") != 6, F.col("l_discount") * 10))
    return li.select("l_orderkey", "l_partkey", "l_linenumber", t["status"].alias("status"), t["confidence"].alias("confidence"))


ASSESS_IN = """i AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS epc_valid, 50.0 AS epc_total, CAST(l_quantity AS BIGINT) AS valid_px, CAST(60 AS BIGINT) AS field_px,
 l_discount * 4 AS cloud, l_tax * 3 AS shadow, CASE WHEN l_linenumber = 5 THEN 0.12 ELSE 0.0 END AS snow, CASE WHEN l_linenumber = 6 THEN NULL ELSE 0.5 + l_discount * 4 END AS purity,
 CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_quantity / 3.0 END AS interior, l_returnflag <> 'R' AS buffered, l_tax * 10 AS acres, CASE l_returnflag WHEN 'A' THEN 'high' WHEN 'N' THEN 'medium' ELSE 'low' END AS geom FROM lineitem)"""


@query(
    f"""WITH {ASSESS_IN}, s AS (SELECT *, epc_valid / epc_total AS f FROM i),
s1 AS (SELECT *, (0.5 * least(f / 0.5, 1.0) + 0.2 * least(epc_valid / 50.0, 1.0) + 0.3 * greatest(0.0, 1.0 - (cloud + shadow))) * CASE WHEN buffered THEN 1.0 ELSE 0.8 END AS s0 FROM s),
s2 AS (SELECT *, round(least(greatest(s0, 0.0), 1.0), 3) AS quality, s0 * CASE WHEN purity < 0.6 THEN 0.75 WHEN purity IS NULL AND acres < 0.25 THEN 0.65 ELSE 1.0 END * CASE geom WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.85 ELSE 0.55 END AS sc,
  CASE WHEN epc_valid >= 8 THEN 0 WHEN epc_valid >= 5 THEN 1 WHEN epc_valid >= 3 THEN 2 ELSE 3 END AS b0 FROM s1),
s3 AS (SELECT *, CASE WHEN interior IS NOT NULL THEN CASE WHEN interior >= 10 THEN 'high' WHEN interior >= 3 THEN 'low' ELSE 'insufficient' END ELSE (['high', 'medium', 'low', 'insufficient'])[CASE WHEN purity < 0.6 THEN least(b0 + 1, 2) ELSE b0 END + 1] END AS ev FROM s2),
s4 AS (SELECT *, greatest(floor((least(greatest(least(sc, CASE ev WHEN 'medium' THEN 0.74 WHEN 'low' THEN 0.54 WHEN 'insufficient' THEN 0.30 ELSE 9.0 END), 0.0), CAST(CAST(quality AS FLOAT) AS DOUBLE)) - 1e-6) * 1e6) / 1e6, 0.0) AS confidence,
  CASE WHEN cloud > 0.30 THEN 'field cloud' WHEN shadow > 0.20 THEN 'field shadow' WHEN snow > 0.10 THEN 'field snow' WHEN f < 0.5 THEN 'valid_fraction' WHEN quality < 0.35 THEN 'quality_score' END AS reject FROM s3)
SELECT l_orderkey, l_partkey, l_linenumber, round(quality, 3) AS quality, round(confidence, 4) AS confidence, CASE WHEN reject IS NOT NULL THEN 'rejected' WHEN confidence >= 0.75 THEN 'high' WHEN confidence >= 0.55 THEN 'medium' ELSE 'low' END AS level,
  CASE WHEN reject IS NOT NULL THEN 'rejected' ELSE ev END AS evidence, reject AS gate FROM s4"""
)
def quality_assess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ29, FLT5: the whole of the quality and confidence contract."""
    li = B.table(spark, sf_dir, "lineitem")
    a = E.assess(
        epc_valid=F.col("l_quantity"),
        epc_total=F.lit(50.0),
        valid_px=F.col("l_quantity").cast("long"),
        field_px=F.lit(60).cast("long"),
        cloud=F.col("l_discount") * 4,
        shadow=F.col("l_tax") * 3,
        snow=F.when(F.col("l_linenumber") == 5, 0.12).otherwise(0.0),
        purity=F.when(F.col("l_linenumber") != 6, 0.5 + F.col("l_discount") * 4),
        interior_epc=F.when(F.col("l_linestatus") != "O", F.col("l_quantity") / 3.0),
        buffered=F.col("l_returnflag") != "R",
        acres=F.col("l_tax") * 10,
        geometry=F.when(F.col("l_returnflag") == "A", "high").when(F.col("l_returnflag") == "N", "medium").otherwise("low"),
    )
    own = li.select("l_orderkey", "l_partkey", "l_linenumber", a.alias("a"))
    gate = F.regexp_extract("a.reject_reason", "^(field [a-z]+|[a-z_]+)", 1)
    return own.select("l_orderkey", "l_partkey", "l_linenumber", F.round("a.quality", 3).alias("quality"), F.round("a.confidence", 4).alias("confidence"), F.col("a.level").alias("level"), F.col("a.evidence").alias("evidence"), gate.alias("gate"))


ROBUST = """good AS (SELECT field, v, round(w * 10) AS w FROM ndvi WHERE v IS NOT NULL AND w > 0),
c AS (SELECT *, sum(w) OVER (PARTITION BY field ORDER BY v, w ROWS UNBOUNDED PRECEDING) / sum(w) OVER (PARTITION BY field) AS s FROM good),
med AS (SELECT field, min(CASE WHEN s >= 0.5 THEN v END) AS median, min(CASE WHEN s >= 0.1 THEN v END) AS p10, min(CASE WHEN s >= 0.9 THEN v END) AS p90, count(*) AS n_cells, sum(w) AS effective FROM c GROUP BY field),
dev AS (SELECT g.field, abs(v - median) AS d, w FROM good g JOIN med ON g.field = med.field),
dc AS (SELECT *, sum(w) OVER (PARTITION BY field ORDER BY d, w ROWS UNBOUNDED PRECEDING) / sum(w) OVER (PARTITION BY field) AS s FROM dev),
mad AS (SELECT field, min(CASE WHEN s >= 0.5 THEN d END) AS mad FROM dc GROUP BY field)"""


@query(
    f"""WITH {B.CELLS_SQL}, {ROBUST} SELECT med.field, n_cells, round(effective, 6) AS effective_cells, round(median, 6) AS median, round(mad, 6) AS mad, round(p10, 6) AS p10, round(p90, 6) AS p90,
  round(0.3 - median, 6) AS delta, round(CASE WHEN mad > 1e-9 THEN (0.3 - median) / (1.4826 * mad) END, 5) AS robust_z FROM med JOIN mad ON med.field = mad.field"""
)
def context_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG7, AG8. Weights are whole tenths, so that shares are the same in any order of summing."""
    cells = B.ndvi(spark, sf_dir).withColumn("w", F.round(F.col("w") * 10))
    parcel = B.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("field")).distinct().withColumn("parcel_ndvi", F.lit(0.3))
    out = stats.context_summary(cells, ["field"], "v", "w", parcel)
    return out.select("field", "n_cells", *[F.round(c, 6).alias(c) for c in ("effective_cells", "median", "mad", "p10", "p90", "delta")], F.round("robust_z", 5).alias("robust_z"))


@query(
    f"""WITH {B.CELLS_SQL}, {ROBUST}, z AS (SELECT med.field, n_cells, median, mad, CASE WHEN n_cells >= 650 THEN 'real' ELSE 'indicative' END AS tier,
  sqrt((1.4826 * mad) * (1.4826 * mad) + 0.02 * 0.02 + (1.2533 * (1.4826 * mad) / sqrt(n_cells)) * (1.2533 * (1.4826 * mad) / sqrt(n_cells))) AS den FROM med JOIN mad ON med.field = mad.field)
SELECT field, tier, round(0.3 - median, 6) AS delta, round(CASE WHEN tier = 'real' AND den > 1e-9 THEN (0.3 - median) / den END, 5) AS z FROM z"""
)
def parcel_vs_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ32: a verdict only from a real ring."""
    s = stats.context_summary(B.ndvi(spark, sf_dir).withColumn("w", F.round(F.col("w") * 10)), ["field"], "v", "w").withColumn("tier", F.when(F.col("n_cells") >= 650, "real").otherwise("indicative"))
    d = E.context_delta(F.lit(0.3), F.col("median"), F.col("mad"), F.col("n_cells"), F.lit(0.02), F.col("tier"))
    return s.select("field", "tier", F.round(d["delta"], 6).alias("delta"), F.round(d["z"], 5).alias("z"))


@query(
    f"""WITH {B.CELLS_SQL}, x AS (SELECT field, scene, layer_code, value FROM (
  SELECT field, scene, 'mndwi' AS layer_code, CASE WHEN abs(g + b) > 1e-6 THEN (g - b) / (g + b) END AS value FROM cells WHERE w > 0 AND scl NOT IN (8, 9, 10, 2, 3, 11)
  UNION ALL SELECT field, scene, 'ndmi', CASE WHEN abs(a + b) > 1e-6 THEN (a - b) / (a + b) END FROM cells WHERE w > 0 AND scl NOT IN (8, 9, 10, 2, 3, 11)) t)
SELECT field, scene, layer_code, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.9), 6) AS p90,
  round(min(value), 6) AS min, round(max(value), 6) AS max, round(count(value) / count(*), 6) AS valid_fraction, count(value) AS n_valid FROM x GROUP BY field, scene, layer_code"""
)
def water_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG9, CD6, JN17 as an unpivot."""
    visible = (F.col("w") > 0) & ~stats.scl_class(F.col("scl")).isin("cloud", "shadow", "snow")
    layers = {"mndwi": S.guarded_ratio(F.col("g"), F.col("b")), "ndmi": S.guarded_ratio(F.col("a"), F.col("b"))}
    return rounded(stats.layer_stats(B.cells(spark, sf_dir), ["field", "scene"], layers, visible), ["field", "scene", "layer_code"])


QUARTERS = """k AS (SELECT *, sum(r * w) OVER (PARTITION BY field) / sum(w) OVER (PARTITION BY field) AS r0, sum(c * w) OVER (PARTITION BY field) / sum(w) OVER (PARTITION BY field) AS c0 FROM ndvi),
qs AS (SELECT field, CASE WHEN r < r0 THEN 'N' ELSE 'S' END || CASE WHEN c >= c0 THEN 'E' ELSE 'W' END AS quarter, count(*) FILTER (WHERE w >= 0.99 AND w > 0 AND v IS NOT NULL) AS interior_cells, sum(w) AS epc0,
  sum(CASE WHEN v IS NOT NULL AND w > 0 THEN v * w END) / sum(CASE WHEN v IS NOT NULL AND w > 0 THEN w END) AS ndvi, sum(CASE WHEN w > 0 THEN g * w END) / sum(CASE WHEN w > 0 THEN w END) AS ndre, sum(CASE WHEN w > 0 THEN b * w END) / sum(CASE WHEN w > 0 THEN w END) AS ndmi
  FROM k GROUP BY 1, 2)"""


@query(f"WITH {B.CELLS_SQL}, {QUARTERS} SELECT field, quarter, interior_cells, round(epc0, 3) AS epc, round(CASE WHEN interior_cells >= 2 THEN ndvi END, 6) AS ndvi, round(CASE WHEN interior_cells >= 2 THEN ndre END, 6) AS ndre, round(CASE WHEN interior_cells >= 2 THEN ndmi END, 6) AS ndmi FROM qs")
def zone_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG16, AG17."""
    means = {"ndvi": "v", "ndre": "g", "ndmi": "b"}
    q = zones.quarters(B.ndvi(spark, sf_dir), "field", "r", "c", "w", "w", means)
    # weights in tenths make means that are right on half of the sixth place: rounded as the SQL does, by their product with 10^6
    return q.withColumns({m: F.round(F.col(m) * 1e6) / 1e6 for m in means})


@query(
    f"""WITH {B.CELLS_SQL}, {QUARTERS}, j AS (SELECT * FROM (SELECT field, quarter, interior_cells, CASE WHEN interior_cells >= 2 THEN ndvi * 4 END AS ndvi, CASE WHEN interior_cells >= 2 THEN ndmi * 4 END AS ndmi FROM qs) z),
g AS (SELECT field, sum(interior_cells) AS n_int, count(ndvi) AS judged, min(ndvi) AS mn, arg_min(quarter, ndvi) AS low, median(ndvi) AS md, median(ndmi) AS wmd, min(ndmi) AS wmn, arg_min(quarter, ndmi) AS wlow FROM j GROUP BY field)
SELECT field, CASE WHEN n_int < 4 THEN 'field_too_small' WHEN judged < 2 THEN 'too_few_judged_quarters' WHEN NOT (md - mn >= 0.05 AND md - mn >= 0.06) THEN 'gap_within_noise' WHEN field % 2 = 0 AND low = 'NE' THEN 'gap_persists_two_passes' ELSE 'gap_one_pass' END AS reason,
  CASE WHEN n_int < 4 OR judged < 2 OR NOT (md - mn >= 0.06) THEN 'none' WHEN field % 2 = 0 AND low = 'NE' THEN 'check' ELSE 'watch' END AS level, CASE WHEN n_int >= 4 AND judged >= 2 THEN low END AS weakest,
  CASE WHEN n_int >= 4 AND judged >= 2 AND wmd - wmn >= 0.05 THEN 'watch' ELSE 'none' END AS water_level FROM g"""
)
def zone_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section 2.10 with the previous pass's state."""
    q = zones.quarters(B.ndvi(spark, sf_dir), "field", "r", "c", "w", "w", {"ndvi": "v", "ndre": "g", "ndmi": "b"})
    q = q.select("field", "quarter", "interior_cells", "epc", *[(F.col(c) * 4).alias(c) for c in ("ndvi", "ndre", "ndmi")])
    even = F.col("field") % 2 == 0
    fields = q.groupBy("field").agg(F.median("ndvi").alias("median")).select("field", "median", F.lit(0.03).alias("se"), F.lit("high").alias("evidence"), F.when(even, "NE").alias("prev_weakest"), F.when(even, "watch").alias("prev_level"), F.lit(None).cast("string").alias("prev_water_weakest"), F.lit(None).cast("string").alias("prev_water_level"))
    return zones.assess(q, fields, "field").select("field", "reason", "level", "weakest", "water_level")


@query(
    """WITH g AS (SELECT l_suppkey AS field, CAST(l_orderkey % 12 AS INT) AS r, CAST(l_linenumber AS INT) AS c, max(CASE WHEN l_orderkey % 7 = 0 THEN 9 WHEN l_orderkey % 7 = 1 THEN 3 WHEN l_orderkey % 7 = 2 THEN 0 WHEN l_orderkey % 7 = 3 THEN 7 ELSE 4 END) AS scl FROM lineitem GROUP BY 1, 2, 3),
n AS (SELECT field, r + dr AS r, c + dc AS c, max(CASE WHEN scl IN (8, 9, 10) THEN 2 ELSE 1 END) AS k FROM g, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) s(dr, dc) WHERE scl IN (8, 9, 10, 3) GROUP BY 1, 2, 3)
SELECT g.field, g.r, g.c, CASE WHEN scl <> 0 AND scl NOT IN (8, 9, 10) AND k = 2 THEN 9 WHEN scl <> 0 AND scl NOT IN (8, 9, 10) AND k = 1 THEN 3 ELSE scl END AS scl FROM g LEFT JOIN n ON g.field = n.field AND g.r = n.r AND g.c = n.c"""
)
def cloud_dilation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE5."""
    k = F.col("l_orderkey") % 7
    code = F.when(k == 0, 9).when(k == 1, 3).when(k == 2, 0).when(k == 3, 7).otherwise(4)
    g = B.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("field"), (F.col("l_orderkey") % 12).cast("int").alias("r"), F.col("l_linenumber").cast("int").alias("c")).agg(F.max(code).alias("scl"))
    return stats.dilate(g, ["field"], "r", "c", "scl").select("field", "r", "c", "scl")
