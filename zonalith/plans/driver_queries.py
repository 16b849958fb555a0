"""Queries of the nightly run, with a measure that SQL can express in place of the whole quality contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonalith.operators import geometry as G, rules
from zonalith.plans import bindings as B, land_driver as D
from zonalith.plans.catalog import query

AS_OF, DATES = "1998-10-01", ("1998-10-01", "1998-08-01", "1998-07-01", "1998-01-01")
MONTHS = ", ".join(f"(DATE '{d}')" for d in DATES)

LANDS_SQL = f"""l AS (SELECT s_suppkey AS land, CASE WHEN s_suppkey % 11 > 0 THEN 'g' || CAST(s_suppkey % 4 AS VARCHAR) END AS fp FROM supplier),
m(d) AS (VALUES {MONTHS}),
found AS (SELECT land, fp, d, strftime(d, '%Y-%m') || CASE t WHEN 0 THEN '' ELSE 'b' END AS scene, t FROM l, m, (VALUES (0), (1)) x(t) WHERE (t = 0 OR land % 5 = 0) AND fp IS NOT NULL AND d >= DATE '{AS_OF}' - 120 AND (land + month(d)) % 13 > 0),
items AS (SELECT *, CASE WHEN (land + month(d)) % 3 = 0 AND land % 4 < 3 THEN land % 2 = 0 END AS known FROM (SELECT *, row_number() OVER (PARTITION BY land, d ORDER BY CASE WHEN t = 1 AND land % 2 = 0 THEN 2.0 ELSE 0.0 END + CASE t WHEN 0 THEN 0.5 ELSE 0.4 END DESC, scene) AS pick FROM found) f WHERE pick = 1),
c AS (SELECT l_suppkey AS land, date_trunc('month', l_shipdate)::DATE AS d, count(*) FILTER (WHERE (l_orderkey + l_linenumber) % 12 IN (4, 5)) AS crop, round(avg(l_quantity) / 100, 6) AS v, count(*) AS n FROM lineitem GROUP BY 1, 2),
e AS (SELECT i.land, i.fp, i.d, i.scene, i.known, c.land IS NOT NULL AS has, crop >= 1 AS ok, v FROM items i LEFT JOIN c ON i.land = c.land AND i.d = c.d),
o AS (SELECT land, count(*) AS kept, count(known) AS known, coalesce(bool_or(known), false) AS prior, count(*) FILTER (WHERE known IS NULL AND has AND ok) AS accepted, count(*) FILTER (WHERE known IS NULL AND has AND NOT ok) AS rejected, count(*) FILTER (WHERE known IS NULL AND NOT has) AS retry FROM e GROUP BY land),
r0 AS (SELECT l.land, coalesce(f.n, 0) AS items, coalesce(kept, 0) AS kept, coalesce(known, 0) AS known, coalesce(prior, false) AS prior, coalesce(accepted, 0) AS accepted, coalesce(rejected, 0) AS rejected, coalesce(retry, 0) AS retry, fp FROM l LEFT JOIN (SELECT land, count(*) AS n FROM found GROUP BY land) f ON f.land = l.land LEFT JOIN o ON o.land = l.land),
rad AS (SELECT r0.land, count(*) AS radar, count(*) FILTER (WHERE n >= 3) AS radar_ok FROM r0 JOIN c ON c.land = r0.land AND c.d = (SELECT max(d) FROM m WHERE d <= DATE '{AS_OF}' - CAST(r0.land % 2 * 40 AS INTEGER) AND d >= DATE '{AS_OF}' - 90) WHERE fp IS NOT NULL AND accepted = 0 AND NOT prior GROUP BY r0.land)"""


def run(spark: SparkSession, sf_dir: str, **how) -> D.Night:
    """The test tables as lands, scenes, cells, passes and ledger."""
    k = F.col("s_suppkey")
    lands = B.table(spark, sf_dir, "supplier").select(k.alias("land_id"), F.lit("t").alias("tenant_id"), (k % 5 / 2.0).alias("acres"), F.lit("high").alias("geometry_confidence"), F.lit(True).alias("buffered"), F.when(k % 11 > 0, F.concat(F.lit("g"), (k % 4).cast("string"))).alias("geometry_fingerprint"))
    land, day = F.col("land_id"), F.col("acquisition_date")
    dated = lands.select("land_id", F.explode(F.array(*[F.lit(d).cast("date") for d in DATES])).alias("acquisition_date"))
    name = F.date_format(day, "yyyy-MM")
    tiles = dated.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("t")).where("t = 0 or land_id % 5 = 0").where((land + F.month(day)) % 13 > 0)
    scenes = tiles.select("land_id", F.concat(name, F.when(F.col("t") == 1, "b").otherwise("")).alias("scene_id"), "acquisition_date", day.alias("acquired_at"), F.lit(None).cast("double").alias("cloud"), ((F.col("t") == 1) & (land % 2 == 0)).alias("contains"), F.when(F.col("t") == 0, 0.5).otherwise(0.4).alias("overlap"))
    li = B.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("land_id"), F.trunc("l_shipdate", "month").alias("d"), F.col("l_quantity").alias("q"), ((F.col("l_orderkey") + F.col("l_linenumber")) % 12).alias("scl")).where(F.col("d").isin(*[F.lit(d).cast("date") for d in DATES]))
    cells = li.withColumn("scene_id", F.explode(F.array(F.date_format("d", "yyyy-MM"), F.concat(F.date_format("d", "yyyy-MM"), F.lit("b")))))
    radar_cells = li.withColumn("scene_id", F.concat(F.lit("r"), F.date_format("d", "yyyy-MM")))
    passes = dated.where(day <= F.date_sub(F.lit(AS_OF).cast("date"), (land % 2 * 40).cast("int"))).select("land_id", F.concat(F.lit("r"), name).alias("scene_id"), "acquisition_date")
    ledger = scenes.join(lands.select("land_id", "geometry_fingerprint"), "land_id").where(((land + F.month(day)) % 3 == 0) & (land % 4 < 3))
    ledger = ledger.select("land_id", "scene_id", "geometry_fingerprint", "acquisition_date", F.lit("v").alias("pipeline_version"), F.when(land % 2 == 0, "accepted").otherwise("rejected").alias("outcome"))

    def measure(read: DataFrame, lands: DataFrame) -> DataFrame:
        g = read.groupBy(*D.KEYS).agg(F.count_if(F.col("scl").isin(4, 5)).alias("crop"), F.round(F.avg("q") / 100, 6).alias("ndvi_value"))
        return g.select(*D.KEYS, "ndvi_value", F.when(F.col("crop") < 1, "crop cells 0 < 1").alias("reject_reason"))

    def measure_radar(read: DataFrame, lands: DataFrame) -> DataFrame:
        g = read.groupBy(*D.KEYS).agg(F.count("*").alias("n"))
        return g.select(*D.KEYS, F.when(F.col("n") < 3, "valid_pixels < 3").alias("reject_reason"))

    history = dated.limit(0).withColumn("ndvi_value", F.lit(0.0))
    return D.night(lands, scenes, cells, passes, radar_cells, ledger, history, "v", F.lit(AS_OF).cast("date"), lookback=120, radar_days=90, measure=measure, measure_radar=measure_radar, **how)


@query(
    f"""WITH {LANDS_SQL} SELECT r0.land AS land_id, items, items - kept AS deduped, known, kept - known AS pending, accepted, rejected, retry, coalesce(radar, 0) AS radar, prior AS prior_accepted,
  CASE WHEN fp IS NULL THEN 'failed' WHEN accepted + coalesce(radar_ok, 0) > 0 THEN 'completed' WHEN prior THEN 'unchanged' ELSE 'no_data' END AS status, accepted > 0 AS snapshot FROM r0 LEFT JOIN rad ON rad.land = r0.land"""
)
def land_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CD2, CD11: the report of every land, radar as fallback."""
    return run(spark, sf_dir).lands


@query(
    f"""WITH {LANDS_SQL}, x AS (SELECT land AS land_id, scene AS scene_id, fp AS geometry_fingerprint, d AS acquisition_date, CASE WHEN ok THEN 'accepted' ELSE 'rejected' END AS outcome, CASE WHEN NOT ok THEN 'crop cells 0 < 1' END AS reason FROM e WHERE known IS NULL AND has
  UNION ALL SELECT r0.land, 'r' || strftime(c.d, '%Y-%m'), fp, c.d, CASE WHEN n >= 3 THEN 'accepted' ELSE 'rejected' END, CASE WHEN n < 3 THEN 'valid_pixels < 3' END FROM rad JOIN r0 ON rad.land = r0.land JOIN c ON c.land = r0.land AND c.d = (SELECT max(d) FROM m WHERE d <= DATE '{AS_OF}' - CAST(r0.land % 2 * 40 AS INTEGER) AND d >= DATE '{AS_OF}' - 90))
SELECT land_id, scene_id, geometry_fingerprint, acquisition_date, 'v' AS pipeline_version, outcome, reason FROM x"""
)
def land_driver_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CD2, CD10, CD3: the ledger rows of the same night; scenes without cells are not among them."""
    return run(spark, sf_dir).ledger


@query(
    """WITH RECURSIVE e AS (SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, CAST(floor(value * 10) AS BIGINT) AS n, event_type = 'purchase' AS r FROM events),
f AS (SELECT run, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS used, CAST(0 AS BIGINT) AS peak, CAST(0 AS BIGINT) AS denied FROM (SELECT DISTINCT run FROM e) d
  UNION ALL SELECT f.run, e.k, u, greatest(peak, u), denied + CASE WHEN NOT r AND used + n > 9000 THEN 1 ELSE 0 END FROM f JOIN e ON e.run = f.run AND e.k = f.k + 1, LATERAL (SELECT CASE WHEN r THEN greatest(used - n, 0) WHEN used + n <= 9000 THEN used + n ELSE used END AS u) z)
SELECT run, max(peak) AS peak_bytes, max(denied) AS denied FROM f GROUP BY run"""
)
def read_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG24: peak and denied reservations of each run."""
    ev = B.table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), "event_id", F.floor(F.col("value") * 10).alias("n"), (F.col("event_type") == "purchase").alias("release"))
    return D.read_counters(ev, "run", "event_id", "n", "release", 9000)


@query(f"WITH {B.SERIES_SQL} SELECT id, land, src FROM series ORDER BY d DESC NULLS LAST, id LIMIT 100")
def capped_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SO2, SO5, SNK9: the newest hundred rows, in the columns that the target knows."""
    s = B.series(spark, sf_dir).orderBy(F.col("d").desc_nulls_last(), "id").limit(100)
    return rules.align_to_schema(s, ["id", "land", "src", "unheard_of"])[0]


@query(
    f"""WITH {B.PARCELS_SQL} SELECT land, land % 3 = 0 AS own, true AS has_boundary, CASE WHEN land % 3 = 0 THEN 'high' WHEN land % 3 = 1 THEN 'medium' ELSE 'low' END AS confidence FROM parcels"""
)
def resolved_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE1: which boundary of a land counts, whole geometry and confidence."""
    p, k = B.parcels(spark, sf_dir), F.col("land")
    g = G.resolve_geometry([F.when(k % 3 == 0, F.col("geojson"))], F.when(k % 3 <= 1, F.col("geojson")), F.col("lat"), F.col("lon"))
    return p.select("land", F.coalesce(g["geojson"] == F.when(k % 3 == 0, F.col("geojson")), F.lit(False)).alias("own"), F.length(g["geojson"]).isNotNull().alias("has_boundary"), g["confidence"].alias("confidence"))
