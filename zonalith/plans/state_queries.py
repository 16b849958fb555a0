"""Queries over state: ledger, merges, snapshots, updates, run summaries, sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonalith.operators import incremental as I, rules
from zonalith.plans import bindings as B
from zonalith.plans.catalog import query
from zonalith.sources import lands, scenes

SINCE = "1996-01-01"
KNOWN = f"known AS (SELECT land_id, scene_id, geometry_fingerprint, max(CASE WHEN outcome = 'accepted' THEN 1 ELSE 0 END) AS ok FROM ledger WHERE pipeline_version = 'v3' AND acquisition_date >= DATE '{SINCE}' GROUP BY 1, 2, 3)"


def _since():
    return F.lit(SINCE).cast("date")


@query(f"WITH {B.LEDGER_SQL}, {KNOWN} SELECT c.land_id, c.scene_id FROM candidates c LEFT JOIN known k ON c.land_id = k.land_id AND c.scene_id = k.scene_id AND c.geometry_fingerprint = k.geometry_fingerprint WHERE k.ok IS NULL")
def ledger_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1, SM3."""
    return I.unseen(B.candidates(spark, sf_dir), B.ledger(spark, sf_dir), "v3", _since()).select("land_id", "scene_id")


@query(f"WITH {B.LEDGER_SQL}, {KNOWN} SELECT c.land_id FROM candidates c LEFT JOIN known k ON c.land_id = k.land_id AND c.scene_id = k.scene_id AND c.geometry_fingerprint = k.geometry_fingerprint GROUP BY c.land_id HAVING bool_and(k.ok IS NOT NULL) AND max(coalesce(k.ok, 0)) = 1")
def land_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN2."""
    return I.unchanged_lands(B.candidates(spark, sf_dir), B.ledger(spark, sf_dir), "v3", _since())


@query(f"WITH {B.LEDGER_SQL}, {KNOWN} SELECT DISTINCT c.scene_id FROM candidates c LEFT JOIN known k ON c.land_id = k.land_id AND c.scene_id = k.scene_id AND c.geometry_fingerprint = k.geometry_fingerprint WHERE k.ok IS NULL")
def needed_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN3."""
    return I.needed_scenes(I.unseen(B.candidates(spark, sf_dir), B.ledger(spark, sf_dir), "v3", _since()))


@query(
    f"""WITH {B.SERIES_SQL}, t AS (SELECT id, land, v FROM series WHERE id % 3 > 0), s AS (SELECT id + CASE WHEN id % 2 = 0 THEN 1 ELSE 0 END AS id, land, v * 2 AS v FROM series WHERE id % 4 = 0),
l AS (SELECT id, max(land * 1000.0 + v) AS x, arg_max(land, land * 1000.0 + v) AS land, arg_max(v, land * 1000.0 + v) AS v FROM s GROUP BY id)
SELECT id, land, round(v, 6) AS v FROM t WHERE id NOT IN (SELECT id FROM l) UNION ALL SELECT id, land, round(v, 6) FROM l"""
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1."""
    s = B.series(spark, sf_dir)
    source = s.where("id % 4 = 0").select((F.col("id") + F.when(F.col("id") % 2 == 0, 1).otherwise(0)).alias("id"), "land", (F.col("v") * 2).alias("v"))
    return I.merge_upsert(s.where("id % 3 > 0").select("id", "land", "v"), source, ["id"]).select("id", "land", F.round("v", 6).alias("v"))


@query(f"WITH {B.SERIES_SQL} SELECT land, count(*) AS new_rows FROM series WHERE id % 3 = 0 GROUP BY land")
def new_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2."""
    s = B.series(spark, sf_dir)
    return I.new_rows(s.where("id % 3 > 0"), s, ["id"], "land")


UPDATES = """ev AS (SELECT land, id, CASE WHEN id % 3 = 0 THEN v END AS value, CASE WHEN id % 4 = 0 THEN src END AS status, CASE WHEN id % 5 = 0 THEN 'n' || CAST(id % 10 AS VARCHAR) END AS note FROM series),
u AS (SELECT land, arg_max(value, id) FILTER (WHERE value IS NOT NULL) AS value, arg_max(status, id) FILTER (WHERE status IS NOT NULL) AS status, arg_max(note, id) FILTER (WHERE note IS NOT NULL) AS note FROM ev GROUP BY land)"""


def _updates(spark, sf_dir):
    s, i = B.series(spark, sf_dir), F.col("id")
    ev = s.select("land", "id", F.when(i % 3 == 0, F.col("v")).alias("value"), F.when(i % 4 == 0, F.col("src")).alias("status"), F.when(i % 5 == 0, F.concat(F.lit("n"), (i % 10).cast("string"))).alias("note"))
    return I.coalesce_updates(ev, "land", "id", ["value", "status", "note"])


@query(f"WITH {B.SERIES_SQL}, {UPDATES} SELECT land, round(value, 6) AS value, status, note FROM u")
def update_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4."""
    return _updates(spark, sf_dir).select("land", F.round("value", 6).alias("value"), "status", "note")


@query(
    f"""WITH {B.SERIES_SQL}, {UPDATES}, l AS (SELECT c_custkey AS id, c_acctbal AS value, false AS tested, 'old' AS status, 'old note' AS note FROM customer)
SELECT l.id, round(CASE WHEN u.land IS NOT NULL AND u.land % 2 = 0 AND u.value IS NOT NULL THEN u.value ELSE l.value END, 6) AS value, coalesce(u.land % 2 = 0 AND u.value IS NOT NULL, false) AS tested, coalesce(u.status, l.status) AS status, CASE WHEN u.note IS NOT NULL THEN u.note ELSE l.note END AS note FROM l LEFT JOIN u ON l.id = u.land"""
)
def apply_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3, SNK5, JN13."""
    c = B.table(spark, sf_dir, "customer")
    own = c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"), F.lit(False).alias("tested"), F.lit("old").alias("status"), F.lit("old note").alias("note"), F.lit(None).cast("string").alias("thumbnail"))
    u = _updates(spark, sf_dir).select(F.col("land").alias("id"), ((F.col("land") % 2 == 0) & F.col("value").isNotNull()).alias("has_snapshot"), "value", "status", F.col("note").isNotNull().alias("set_note"), "note", F.lit(None).cast("string").alias("thumbnail"))
    return I.apply_updates(own, u).select("id", F.round("value", 6).alias("value"), "tested", "status", "note")


@query(
    f"""WITH {B.SERIES_SQL}, cur AS (SELECT land, max(d) AS d FROM series WHERE id % 2 = 0 GROUP BY land), inc AS (SELECT land, max(d) AS d FROM series WHERE id % 7 = 1 GROUP BY land)
SELECT coalesce(cur.land, inc.land) AS land, CASE WHEN cur.d IS NULL OR inc.d >= cur.d THEN coalesce(inc.d, cur.d) ELSE cur.d END AS d, CASE WHEN cur.d IS NULL OR inc.d >= cur.d THEN 'new' ELSE 'old' END AS origin FROM cur FULL JOIN inc ON cur.land = inc.land"""
)
def snapshot_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SM4."""
    s = B.series(spark, sf_dir)
    side = lambda c, o: s.where(c).groupBy("land").agg(F.max("d").alias("d")).withColumn("origin", F.lit(o))
    return I.snapshot_forward(side("id % 2 = 0", "old"), side("id % 7 = 1", "new"), "land", "d")


@query(
    f"""WITH {B.LEDGER_SQL}, t AS (SELECT land_id, scene_id, geometry_fingerprint, outcome FROM ledger WHERE NOT (o_orderkey % 11 = 0))
SELECT outcome, count(*) AS n FROM t WHERE (land_id, scene_id) NOT IN (SELECT land_id, scene_id FROM ledger WHERE o_orderkey % 13 = 0) GROUP BY outcome"""
)
def ledger_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CD10, SM2."""
    led = B.ledger(spark, sf_dir).where("not (o_orderkey % 11 = 0)").withColumn("reason", F.lit("field cloud 40% > 30%"))
    retry = B.ledger(spark, sf_dir).where("o_orderkey % 13 = 0")
    return I.ledger_outcomes(led.where("outcome = 'accepted'"), led.where("outcome = 'rejected'"), retry, "v3").groupBy("outcome").agg(F.count("*").alias("n"))


STATUS = """r AS (SELECT c_custkey AS land, c_custkey % 17 = 0 AS error, c_custkey % 4 AS n_rows, c_custkey % 3 = 0 AS prior, c_custkey % 13 <> 0 AS stored, c_custkey % 19 <> 0 AS promoted, c_custkey % 2 AS n_opt FROM customer),
st AS (SELECT *, CASE WHEN error THEN 'failed' WHEN n_rows = 0 AND prior THEN 'unchanged' WHEN n_rows = 0 THEN 'no_data' WHEN NOT stored THEN 'failed' WHEN NOT promoted THEN 'failed' ELSE 'completed' END AS status FROM r)"""


def _status(spark, sf_dir):
    k = F.col("c_custkey")
    c = B.table(spark, sf_dir, "customer").select(k.alias("land"), (k % 17 == 0).alias("error"), (k % 4).alias("n_rows"), (k % 3 == 0).alias("prior_accepted"), (k % 13 != 0).alias("stored"), (k % 19 != 0).alias("promoted"), (k % 2).alias("n_optical"))
    return I.land_status(c)


@query(f"WITH {STATUS} SELECT land, status, status = 'completed' AND n_opt > 0 AS snapshot FROM st")
def land_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CD9."""
    return _status(spark, sf_dir).select("land", "status", "snapshot")


@query(
    f"""WITH {STATUS}, n AS (SELECT status, CASE WHEN land % 5 = 0 THEN -1 ELSE land % 3 END AS n_obs FROM st)
SELECT count(*) AS lands, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'no_data') AS no_data, count(*) FILTER (WHERE status = 'unchanged') AS unchanged,
  CAST(coalesce(sum(CASE WHEN n_obs >= 0 THEN n_obs END), 0) AS BIGINT) AS observations, count(*) FILTER (WHERE n_obs < 0) AS unverified, round(100.0 * count(*) FILTER (WHERE status = 'no_data') / nullif(count(*) FILTER (WHERE status <> 'unchanged'), 0), 1) AS skip_rate_pct FROM n"""
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7, AG19, AG23."""
    s = _status(spark, sf_dir)
    return I.run_summary(s.withColumn("n_obs", F.when(F.col("land") % 5 == 0, -1).otherwise(F.col("land") % 3)))


@query("SELECT split_part(reason, ' ', 1) AS reason, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'cloud over field' WHEN o_orderkey % 3 = 1 THEN o_orderpriority || ' priority' END AS reason FROM orders) t WHERE reason IS NOT NULL GROUP BY 1")
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG18, SO6."""
    k = F.col("o_orderkey") % 3
    o = B.table(spark, sf_dir, "orders").select(F.when(k == 0, "cloud over field").when(k == 1, F.concat("o_orderpriority", F.lit(" priority"))).alias("reason"))
    return I.reason_counts(o, "reason")


@query("SELECT c_nationkey AS farmer, count(*) AS lands, round(sum(c_acctbal), 2) AS acres FROM customer GROUP BY c_nationkey")
def farmer_acres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG20."""
    c = B.table(spark, sf_dir, "customer")
    return c.groupBy(F.col("c_nationkey").alias("farmer")).agg(F.count("*").alias("lands"), F.round(F.sum("c_acctbal"), 2).alias("acres"))


@query(f"WITH {B.SERIES_SQL}, b AS (SELECT DISTINCT land, d FROM series WHERE src = 'purchase') SELECT s.id FROM series s JOIN b ON s.land = b.land AND s.d = b.d WHERE s.src <> 'purchase'")
def superseded_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN15."""
    return I.superseded(B.series(spark, sf_dir), "land", "d", "src", "id", "purchase")


@query(f"WITH {B.SERIES_SQL}, n AS (SELECT land, arg_max(v, (d, id)) AS v FROM series WHERE v IS NOT NULL GROUP BY land) SELECT c_custkey AS id, round(n.v, 6) AS new_value FROM customer LEFT JOIN n ON c_custkey = n.land")
def repair_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN14."""
    own = B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    rows = B.series(spark, sf_dir).withColumnRenamed("id", "event")
    return I.repair_from_newest(own, rows, "id", "land", ["d", "event"], "v").select("id", F.round("new_value", 6).alias("new_value"))


@query(f"WITH {B.SERIES_SQL} SELECT land, d, count(*) AS n FROM series GROUP BY land, d HAVING count(*) > 1")
def dup_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG22."""
    return I.duplicates(B.series(spark, sf_dir), ["land", "d"])


@query(f"WITH {B.SERIES_SQL} SELECT id, CASE WHEN v > 0.9 THEN 'range' ELSE '' END || CASE WHEN src = 'error' THEN 'source' ELSE '' END AS broken FROM series WHERE v > 0.9 OR src = 'error'")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK10."""
    _, bad = I.quarantine(B.series(spark, sf_dir), {"range": F.col("v") <= 0.9, "source": F.col("src") != "error"})
    return bad.select("id", F.array_join("broken_rules", "").alias("broken"))


@query("SELECT a, b, c, k AS pick FROM (SELECT o_custkey % 50 AS a, o_orderstatus AS b, o_orderkey % 5 AS c, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey % 50, o_orderstatus, o_orderkey % 5 ORDER BY CASE WHEN o_orderkey % 3 = 0 THEN 2.0 + o_totalprice ELSE o_totalprice END DESC, o_orderkey) AS rn FROM orders) t WHERE rn = 1")
def tile_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN8."""
    k = F.col("o_orderkey")
    o = B.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("a"), F.col("o_orderstatus").alias("b"), (k % 5).alias("c"), (k % 3 == 0).alias("contains"), F.col("o_totalprice").alias("overlap"), k.alias("pick"))
    o = o.withColumn("k", F.col("pick"))
    return I.dedupe_tiles(o, ["a", "b", "c"], "contains", "overlap", "k").select("a", "b", "c", F.col("k").alias("pick"))


@query("SELECT c_custkey AS id, c_nationkey AS tenant, round(c_acctbal, 2) AS acres FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'MACHINERY' AND c_nationkey = 3")
def eligible_lands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1, SRC2, SRC4, SO1."""
    return _eligible(spark, sf_dir, 3).select("id", "tenant", F.round("acres", 2).alias("acres"))


def _eligible(spark, sf_dir, tenant=None):
    c = B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("tenant"), F.col("c_acctbal").alias("acres"), (F.col("c_acctbal") > 0).alias("is_active"), F.when(F.col("c_mktsegment") == "MACHINERY", F.current_timestamp()).alias("deleted_at"))
    return lands.eligible(c, "tenant", tenant)


@query("SELECT c_custkey AS id, c_nationkey AS tenant FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'MACHINERY' AND c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 50 = 0)")
def lands_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3."""
    ids = B.table(spark, sf_dir, "orders").where("o_orderkey % 50 = 0").select(F.col("o_custkey").alias("id"))
    return lands.by_ids(_eligible(spark, sf_dir), ids, "id").select("id", "tenant")


@query("SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS d FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-06-30' - 20 AND DATE '1996-06-30' AND (CASE WHEN o_orderkey % 9 > 0 THEN o_orderkey % 101 END IS NULL OR o_orderkey % 101 <= 98)")
def scene_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5, FLT1, SM1: scenes of the window that are not opaque; an unknown cloud cover is kept."""
    k = F.col("o_orderkey")
    s = B.table(spark, sf_dir, "orders").select(k.alias("id"), F.col("o_orderdate").cast("date").alias("d"), F.when(k % 9 > 0, (k % 101).cast("double")).alias("cloud"))
    return scenes.search_optical(s, "d", "cloud", F.lit("1996-06-30").cast("date"), 20).select("id", "d")


@query("SELECT a, id, c FROM (SELECT o_custkey % 20 AS a, o_orderkey AS id, CASE WHEN o_orderkey % 5 < 2 THEN 'rtc' ELSE 'grd' END AS c, rank() OVER (PARTITION BY o_custkey % 20 ORDER BY CASE WHEN o_orderkey % 5 < 2 THEN 1 ELSE 2 END) AS k FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus <> 'P') t WHERE k = 1")
def radar_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6: the better collection where it has scenes, with both polarisations."""
    k = F.col("o_orderkey")
    assets = F.when(F.col("o_orderstatus") != "P", F.create_map(F.lit("VV"), F.lit("x"), F.lit("vh"), F.lit("y"))).otherwise(F.create_map(F.lit("vv"), F.lit("x")))
    s = B.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).alias("a"), k.alias("id"), F.when(k % 5 < 2, "rtc").otherwise("grd").alias("c"), F.when(k % 2 == 0, "IW").otherwise("EW").alias("mode"), assets.alias("assets"))
    return scenes.search_radar(s, "a", "c", "mode", "assets", ("rtc", "grd")).select("a", "id", "c")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 't' || CAST(o_custkey % 7 AS VARCHAR) ELSE 'g' || CAST(o_custkey % 5 AS VARCHAR) END AS tile, CASE WHEN o_orderkey % 4 = 0 THEN 'r' WHEN o_orderkey % 4 = 1 THEN 'a' ELSE 'i' END AS crs FROM orders")
def acquisition_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7, SRC11."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    tile = F.create_map(F.lit("s2:mgrs_tile"), F.when(k % 3 == 0, F.concat(F.lit("t"), (c % 7).cast("string"))), F.lit("grid:code"), F.concat(F.lit("g"), (c % 5).cast("string")))
    s = B.table(spark, sf_dir, "orders").select(k.alias("id"), tile.alias("p"))
    crs = scenes.resolve_crs([F.when(F.col("id") % 4 == 0, "r"), F.when(F.col("id") % 4 == 1, "a"), F.lit("i")])
    return s.select("id", scenes.tile_of(F.col("p")).alias("tile"), crs.alias("crs"))


@query("SELECT c_custkey AS id, c_nationkey AS tenant FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def tenant_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT9."""
    c = B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("tenant"))
    return rules.tenant_scope(c, B.table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("tenant")), "tenant")


@query("SELECT o_orderkey AS id, n.n_name AS layer FROM orders JOIN nation n ON o_custkey % 25 = n.n_nationkey")
def config_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC17, JN9, JN16: a layer's configuration by code, an error where there is none."""
    o = B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 25).cast("int").alias("code"))
    cfg = B.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("layer"), F.lit(True).alias("enabled"))
    return scenes.with_config(o, cfg, "code", "layer").select("id", "layer")


@query("SELECT o_orderkey AS id, 'observed' AS kind, o_orderkey % 10 / 10.0 AS observed, o_orderkey % 5 > 0 AS context_present FROM orders WHERE o_orderkey % 3 > 0 AND o_orderstatus <> 'P'")
def observed_intelligence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ31, CD8."""
    from zonalith.operators.intelligence import observed

    k = F.col("o_orderkey")
    rows = B.table(spark, sf_dir, "orders").select(
        F.lit("t1").alias("tenant_id"),
        F.when(k % 3 > 0, k).alias("land_id"),
        k.cast("string").alias("scene_id"),
        F.when(F.col("o_orderstatus") != "P", k % 10 / 10.0).alias("ndvi_value"),
        F.col("o_orderdate").cast("date").alias("acquisition_date"),
        (k % 100 / 100.0).alias("quality_score"),
        F.struct(F.when(k % 5 > 0, 0.5).alias("context_ndvi_mean"), F.lit(0.5).alias("context_ndvi_median"), F.lit(0.1).alias("parcel_context_delta"), F.lit(None).cast("double").alias("parcel_context_robust_z")).alias("context"),
    )
    out = observed(rows)
    return out.select(F.col("land_id").alias("id"), F.col("observed_or_predicted").alias("kind"), F.col("observed_ndvi").alias("observed"), F.col("evidence.context_present").alias("context_present"))
