"""Queries over series: history, trend, regression, forecast, outliers, decision-grade rows, validation pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonalith.functions import evidence as E
from zonalith.operators import rules, temporal as T, validation as V
from zonalith.plans import bindings as B
from zonalith.plans.catalog import query

AS_OF = "2024-01-31"


@query(
    f"""WITH {B.SERIES_SQL} SELECT land, id, d, rank FROM (SELECT *, row_number() OVER (PARTITION BY land ORDER BY d DESC, id DESC) AS rank FROM series WHERE v IS NOT NULL AND d >= DATE '{AS_OF}' - 45) t WHERE rank <= 30"""
)
def optical_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC13, WN6, WN8."""
    s = B.series(spark, sf_dir).where("v is not null")
    return T.history(s, "land", "d", F.lit(AS_OF).cast("date"), tie="id").select("land", "id", "d", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {B.SERIES_SQL} SELECT land, d, id, round(v, 6) AS v FROM (SELECT *, row_number() OVER (PARTITION BY land ORDER BY d DESC, id DESC) AS rn FROM series WHERE v IS NOT NULL) t WHERE rn = 1")
def latest_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC14, WN2, SO3."""
    s = B.series(spark, sf_dir).where("v is not null").select("land", "d", "id", F.round("v", 6).alias("v"))
    return T.latest(s, "land", ["d", "id"])


@query(f"WITH {B.SERIES_SQL} SELECT land, count(*) AS n, min(d) AS first, max(d) AS last, round(avg(v), 6) AS mean FROM series WHERE q >= 0.55 AND v IS NOT NULL AND src <> 'error' GROUP BY land")
def promotable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC15, SRC16: the scan both promotion and forecasting start from."""
    s = B.series(spark, sf_dir).where("q >= 0.55 and v is not null and src <> 'error'")
    return s.groupBy("land").agg(F.count("*").alias("n"), F.min("d").alias("first"), F.max("d").alias("last"), F.round(F.avg("v"), 6).alias("mean"))


TREND = """w AS (SELECT land, d, v, id, date_diff('day', d, max(d) OVER (PARTITION BY land)) AS age, row_number() OVER (PARTITION BY land ORDER BY d DESC, id DESC) AS back, count(*) OVER (PARTITION BY land) AS n_all FROM series WHERE v IS NOT NULL),
n AS (SELECT *, count(*) FILTER (WHERE age <= 21) OVER (PARTITION BY land) AS near FROM w),
u AS (SELECT * FROM n WHERE CASE WHEN n_all < 3 THEN true WHEN near >= 3 THEN age <= 21 ELSE back <= 3 END),
g AS (SELECT land, count(*) AS n_points, max(n_all) AS n_all, regr_slope(v, -CAST(age AS DOUBLE)) AS slope, max(age) - min(age) AS span, arg_max(v, d * 0 + CAST(id AS BIGINT)) AS x FROM (SELECT land, v, id, age, n_all, 0 AS d FROM u) q GROUP BY land),
e AS (SELECT land, max(CASE WHEN f = 1 THEN v END) - max(CASE WHEN b = 1 THEN v END) AS delta FROM (SELECT land, v, row_number() OVER (PARTITION BY land ORDER BY d DESC, id DESC) AS f, row_number() OVER (PARTITION BY land ORDER BY d, id) AS b FROM u) q GROUP BY land)"""


@query(
    f"""WITH {B.SERIES_SQL}, {TREND} SELECT g.land, CASE WHEN n_all >= 3 AND span > 0 THEN round(slope, 9) END AS slope_per_day,
  CASE WHEN NOT (n_all >= 3 AND span > 0) THEN 'insufficient_data' WHEN slope <= -0.010 THEN 'sharp_decline' WHEN slope <= -0.003 THEN 'declining' WHEN slope < 0.003 THEN 'stable' WHEN slope < 0.010 THEN 'improving' ELSE 'sharp_improving' END AS direction,
  n_points, CASE WHEN n_all >= 3 THEN CAST(span AS DOUBLE) END AS span_days, CASE WHEN n_all >= 3 AND span > 0 THEN round(delta, 4) END AS delta_total FROM g JOIN e ON g.land = e.land"""
)
def trend_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG10, AG10b, WN5."""
    return T.trend(B.series(spark, sf_dir), "land", "d", "v", "id", digits=9)


@query(
    f"""WITH {B.SERIES_SQL}, p AS (SELECT land, CAST(date_diff('day', DATE '2024-01-01', d) AS DOUBLE) AS x, v AS y, greatest(q, 0.05) AS w FROM series WHERE v IS NOT NULL),
s AS (SELECT land, sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM p GROUP BY land),
f AS (SELECT land, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS slope, (sy - (sw * sxy - sx * sy) / (sw * sxx - sx * sx) * sx) / sw AS intercept FROM s WHERE abs(sw * sxx - sx * sx) >= 1e-12)
SELECT p.land, round(max(intercept), 6) AS intercept, round(max(slope), 6) AS slope, round(sqrt(sum(w * (y - (intercept + slope * x)) * (y - (intercept + slope * x))) / sum(w)), 6) AS rmse FROM p JOIN f ON p.land = f.land GROUP BY p.land"""
)
def weighted_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG11."""
    p = B.series(spark, sf_dir).where("v is not null").select("land", F.date_diff("d", F.lit("2024-01-01").cast("date")).cast("double").alias("x"), F.col("v").alias("y"), F.greatest("q", F.lit(0.05)).alias("w"))
    out = T.weighted_regression(p, "land", "x", "y", "w").where("slope is not null")
    return out.select("land", *[F.round(c, 6).alias(c) for c in ("intercept", "slope", "rmse")])


FORECAST = """c AS (SELECT land, d, v AS y, greatest(0.05, least(1.0, q)) AS q, id FROM series WHERE v IS NOT NULL AND q >= 0.55),
b AS (SELECT *, row_number() OVER (PARTITION BY land ORDER BY d DESC, y DESC, q DESC, id DESC) AS back, min(d) OVER (PARTITION BY land) AS origin FROM c),
x AS (SELECT *, CAST(date_diff('day', origin, d) AS DOUBLE) AS x FROM b),
h AS (SELECT land, count(*) AS n, max(d) AS latest, min(d) AS origin, max(CASE WHEN back = 1 THEN y END) AS ly, max(CASE WHEN back = 2 THEN d END) AS before, max(CASE WHEN back <= 4 THEN y END) - min(CASE WHEN back <= 4 THEN y END) AS spread FROM x GROUP BY land),
e AS (SELECT * FROM h WHERE n >= 3 AND date_diff('day', origin, latest) > 0 AND date_diff('day', origin, latest) <= 180 AND date_diff('day', before, latest) <= 12),
s AS (SELECT land, sum(q) AS sw, sum(q * x) AS sx, sum(q * y) AS sy, sum(q * x * x) AS sxx, sum(q * x * y) AS sxy FROM x WHERE back <= 12 GROUP BY land),
f AS (SELECT land, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS slope, (sy - (sw * sxy - sx * sy) / (sw * sxx - sx * sx) * sx) / sw AS intercept FROM s WHERE sw > 0 AND abs(sw * sxx - sx * sx) >= 1e-12),
r AS (SELECT x.land, sqrt(sum(q * (y - (intercept + slope * x)) * (y - (intercept + slope * x))) / sum(q)) AS rmse FROM x JOIN f ON x.land = f.land WHERE back <= 12 GROUP BY x.land),
p AS (SELECT e.land, k, latest, n, rmse, greatest(-0.05, least(0.05, slope)) AS slope,
  greatest(-1.0, least(1.0, 0.7 * (intercept + greatest(-0.05, least(0.05, slope)) * (date_diff('day', origin, latest) + k)) + 0.3 * ly)) AS p,
  least(0.35, least(0.30, greatest(0.04, rmse * 2.0) + spread * 0.15) + 0.02 * k) AS u
  FROM e JOIN f ON e.land = f.land JOIN r ON r.land = e.land CROSS JOIN (VALUES (1), (2), (3), (4), (5)) v(k))"""


@query(
    f"""WITH {B.SERIES_SQL}, {FORECAST} SELECT land, 'PREDICTED:' || CAST(land AS VARCHAR) || ':' || strftime(latest + k, '%Y-%m-%d') || ':m1' AS scene_id, CAST(k AS INT) AS horizon_days, round(p, 6) AS estimated,
  round(greatest(-1.0, least(1.0, p - u)), 6) AS low, round(greatest(-1.0, least(1.0, p + u)), 6) AS high, CAST(least(n, 12) AS BIGINT) AS training_count, round(rmse, 6) AS rmse, 'estimated_unvalidated' AS validation_status FROM p"""
)
def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT11, WN6, WN7, section 2.11, CD7."""
    f = T.forecast(B.series(spark, sf_dir), "land", "d", "v", "q", "id")
    out = T.predicted_records(f, "land", "m1")
    return out.select("land", "scene_id", F.col("horizon_days").cast("int").alias("horizon_days"), "estimated", "low", "high", F.col("training_count").cast("long").alias("training_count"), "rmse", "validation_status")


@query(
    f"""WITH {B.SERIES_SQL}, p AS (SELECT DISTINCT land, d, v FROM series WHERE v IS NOT NULL),
h AS (SELECT a.land, a.d, a.v, max(abs(b.v - a.v)) AS m FROM p a JOIN p b ON a.land = b.land AND abs(date_diff('day', a.d, b.d)) BETWEEN 1 AND 7 AND abs(b.v - a.v) > 0.35 GROUP BY 1, 2, 3)
SELECT s.id, h.m IS NOT NULL AS temporal_outlier, round(h.m, 4) AS abs_delta FROM series s LEFT JOIN h ON s.land = h.land AND s.d = h.d AND s.v = h.v"""
)
def temporal_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN10, SM6."""
    s = B.series(spark, sf_dir)
    out = T.temporal_outliers(s, s, "land", "d", "v")
    return out.select("id", "temporal_outlier", F.round("abs_delta", 4).alias("abs_delta"))


@query(f"WITH {B.SERIES_SQL} SELECT id, round(last_value(CASE WHEN q > 0.5 THEN v END IGNORE NULLS) OVER (PARTITION BY land ORDER BY d, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS previous FROM series")
def asof_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN11, WN9."""
    s = B.series(spark, sf_dir).withColumn("x", F.when(F.col("q") > 0.5, F.col("v")))
    return T.as_of_previous(s, "land", ["d", "id"], "x", "previous").select("id", F.round("previous", 6).alias("previous"))


@query(f"WITH {B.SERIES_SQL} SELECT id, date_diff('day', lag(d) OVER (PARTITION BY land ORDER BY d, id), d) AS gap_days FROM series")
def previous_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN7."""
    return T.gaps(B.series(spark, sf_dir), "land", "d", "id").select("id", F.col("gap_days").cast("long").alias("gap_days"))


@query(
    f"""WITH {B.SERIES_SQL}, n AS (SELECT * FROM series WHERE q >= 0.5), o AS (SELECT * FROM series WHERE q < 0.6)
SELECT id, count(*) AS n FROM (SELECT id FROM n UNION ALL SELECT id FROM o WHERE id NOT IN (SELECT id FROM n)) t GROUP BY id"""
)
def trend_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN12, ST1, ST2."""
    s = B.series(spark, sf_dir)
    return T.trend_series(s.where("q >= 0.5"), s.where("q < 0.6"), "id").groupBy("id").agg(F.count("*").alias("n"))


@query(
    f"""WITH {B.SERIES_SQL} SELECT id, land, date_diff('day', d, DATE '{AS_OF}') AS age_days, date_diff('day', d, DATE '{AS_OF}') <= 14 AS is_fresh, row_number() OVER (PARTITION BY land ORDER BY d DESC, id DESC) AS recency_rank
FROM series WHERE src <> 'error' AND v IS NOT NULL AND q >= 0.55 AND (CASE WHEN id % 7 = 0 THEN NULL ELSE id % 11 END IS NULL OR id % 11 >= 3) AND id % 13 <> 0 AND NOT (id % 17 = 0)"""
)
def decision_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT7, WN1, WN11."""
    i = F.col("id")
    out = rules.decision_grade(B.series(spark, sf_dir), F.lit(AS_OF).cast("date"), "land", "d", "id", "v", "q", observed=F.col("src") != "error", epc=F.when(i % 7 != 0, i % 11), low=(i % 13).cast("double"), over_count=i % 17 == 0)
    return out.select("id", "land", F.col("age_days").cast("long").alias("age_days"), "is_fresh", F.col("recency_rank").cast("long").alias("recency_rank"))


CHECKS = {
    "confidence_le_quality": "q * 0.9 <= 0.8 + 1e-6",
    "value_range": "v BETWEEN 0 AND 0.95",
    "source_known": "src IN ('click', 'view', 'purchase')",
    "area_identity": "CASE WHEN id % 3 = 0 THEN v IS NULL OR v * 100.0 <= 60 * 1.02 ELSE true END",
}


@query(f"WITH {B.SERIES_SQL} " + " UNION ALL ".join(f"SELECT id, '{n}' AS rule FROM series WHERE NOT ({c})" for n, c in CHECKS.items()))
def check_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT8."""
    return rules.violations(B.series(spark, sf_dir), {n: F.expr(c) for n, c in CHECKS.items()}, "id")


@query(
    """WITH t AS (SELECT l_orderkey, l_partkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'fractional_coverage_v3' WHEN 'N' THEN 'pixel_mask_v2_2' ELSE 'legacy_v1' END AS m, l_quantity AS epc, l_linenumber * 900.0 AS area, CAST(l_quantity AS BIGINT) AS px, l_linestatus = 'O' AND l_tax > 0.06 AS mixed FROM lineitem)
SELECT m AS method, count(*) AS n, count(*) FILTER (WHERE CASE WHEN m = 'fractional_coverage_v3' THEN epc * 100.0 <= area * 1.02 + 100.0 WHEN m = 'pixel_mask_v2_2' THEN px <= ceil(area / 100.0 * 1.25) + 2 OR mixed ELSE true END) AS plausible FROM t GROUP BY m"""
)
def support_plausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT8: the method-aware bound."""
    flag = F.col("l_returnflag")
    version = F.when(flag == "A", "v3.0").when(flag == "N", "v2.2.1")
    method = rules.stat_method(version, F.lit(None).cast("string"))
    ok = rules.support_plausible(F.col("method"), F.col("l_quantity"), F.col("l_linenumber") * 900.0, F.col("l_quantity").cast("long"), (F.col("l_linestatus") == "O") & (F.col("l_tax") > 0.06))
    return B.table(spark, sf_dir, "lineitem").withColumn("method", method).groupBy("method").agg(F.count("*").alias("n"), F.count_if(ok).alias("plausible"))


PAIRS = """p AS (SELECT l_suppkey AS land, l_tax * 10 AS native, l_tax * 10 + (l_discount - 0.05) AS estimated, l_tax * 10 + (l_discount - 0.04) * 1.5 AS reference FROM lineitem)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, d = F.col("l_tax") * 10, F.col("l_discount")
    return B.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("land"), t.alias("native"), (t + (d - 0.05)).alias("estimated"), (t + (d - 0.04) * 1.5).alias("reference"))


@query(
    f"""WITH {PAIRS} SELECT land, count(*) AS n, round(avg(abs(native - reference)), 6) AS mae, round(sqrt(avg((native - reference) * (native - reference))), 6) AS rmse, round(avg(native - reference), 6) AS bias,
  round(1.0 - sum((native - reference) * (native - reference)) / (var_pop(reference) * count(reference)), 5) AS r2 FROM p GROUP BY land"""
)
def accuracy_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG12."""
    m = V.metrics(pairs(spark, sf_dir), ["land"], "native", "reference")
    return m.select("land", "n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "bias")], F.round("r2", 5).alias("r2"))


@query(
    f"""WITH {PAIRS} SELECT land, CASE WHEN count(*) >= 600 THEN 'evaluated' ELSE 'insufficient_reference_pairs' END AS status, count(*) AS n_pairs, round(avg(abs(native - reference)), 6) AS native_mae, round(avg(abs(estimated - reference)), 6) AS estimated_mae, round(avg(abs(native - reference) - abs(estimated - reference)), 6) AS improvement FROM p GROUP BY land"""
)
def paired_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG13."""
    out = V.paired(pairs(spark, sf_dir), "native", "estimated", "reference", 600, ["land"])
    return out.select("land", "status", "n_pairs", *[F.round(c, 6).alias(c) for c in ("native_mae", "estimated_mae", "improvement")])


@query(f"WITH {PAIRS} SELECT land, count(*) AS n, round(sum(abs(native - reference)), 5) AS native_error, round(sum(abs(estimated - reference)), 5) AS estimated_error FROM p GROUP BY land")
def bootstrap_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG14: the per-land sums that the bootstrap resamples."""
    out = V.cluster_errors(pairs(spark, sf_dir), "land", "native", "estimated", "reference")
    return out.select("land", "n", F.round("native_error", 5).alias("native_error"), F.round("estimated_error", 5).alias("estimated_error"))


@query()
def bootstrap_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG14, CD12: the whole validation job as one row."""
    out = V.bootstrap(pairs(spark, sf_dir), "land", "native", "estimated", "reference")
    return spark.createDataFrame([tuple(out.get(k) for k in ("status", "n_pairs", "n_lands", "ci95_lower", "ci95_upper", "supported"))], "status string, n_pairs long, n_lands long, ci95_lower double, ci95_upper double, supported boolean")


@query("SELECT DISTINCT o_custkey AS land FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def leakage_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3, ST4, AG21."""
    o = B.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("land"), "o_orderstatus")
    return V.leakage(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'P'"), "land")


@query(
    f"""WITH {PAIRS}, l AS (SELECT land, row_number() OVER (ORDER BY md5('42:' || CAST(land AS VARCHAR)), land) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT land FROM p) t)
SELECT land, CASE WHEN k <= greatest(1, round(n * 0.2)) THEN 'test' ELSE 'train' END AS side FROM l"""
)
def grouped_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6."""
    train, test = V.grouped_split(pairs(spark, sf_dir), "land")
    return train.select("land", F.lit("train").alias("side")).distinct().unionByName(test.select("land", F.lit("test").alias("side")).distinct())


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN lower(trim(o_orderpriority)) || ':' || CAST(isoyear(o_orderdate) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(o_orderdate) AS VARCHAR), 2, '0') || ':b' || CAST(o_custkey % 9 AS VARCHAR) END AS cohort,
  CASE WHEN o_custkey % 40 >= 20 THEN 'stage_cohort' WHEN o_custkey % 2 = 0 THEN 'spatial_ring_fallback' ELSE 'none' END AS population,
  CASE WHEN o_custkey % 5 > 0 THEN round(greatest(0.0, least(1.0, 1.0 - (o_orderkey % 30) / CAST(o_custkey % 5 * 5 AS DOUBLE))), 6) END AS support,
  CASE WHEN (CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END) = 4 THEN 'corroborated' ELSE 'insufficient_evidence' END AS water,
  o_custkey % 40 >= 20 AND coalesce(CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 10 / 10.0 END >= 0.6, false) AND o_orderkey % 6 >= 3 AS zone_ok,
  round(least(CASE WHEN o_custkey % 4 > 0 THEN o_custkey % 100 / 100.0 END, o_orderkey % 100 / 100.0, 0.9), 4) AS gate FROM orders"""
)
def decision_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ21-PRJ26."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = B.table(spark, sf_dir, "orders")
    vector = E.uncertainty_vector(F.when(c % 4 > 0, c % 100 / 100.0), k % 100 / 100.0, F.lit(0.9), F.lit(None).cast("double"), F.lit(None).cast("double"))
    return o.select(
        "o_orderkey",
        E.cohort_key(F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")), F.col("o_orderdate").cast("date"), F.concat(F.lit("b"), (c % 9).cast("string"))).alias("cohort"),
        E.context_population(c % 40, F.lit(20), c % 2 == 0).alias("population"),
        F.round(E.temporal_support(k % 30, (c % 5 * 5).cast("double")), 6).alias("support"),
        E.water_stress(c % 2 == 0, k % 2 == 0, k % 3 == 0, c % 3 == 0)["status"].alias("water"),
        E.zone_gate(c % 40, F.lit(20), F.when(k % 4 > 0, k % 10 / 10.0), F.lit(0.6), k % 6, F.lit(3)).alias("zone_ok"),
        F.round(vector["minimum_gate"], 4).alias("gate"),
    )
