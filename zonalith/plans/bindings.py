"""Projections of the test tables to the roles of the measurement tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonalith.session import reach_workers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: One row per cell: field, scene, bands a (near infrared), b (red), g, weight 0..1, grid place, class code.
CELLS_SQL = """
cells AS (
  SELECT l_suppkey AS field, l_returnflag AS scene, l_orderkey, l_partkey,
         l_extendedprice / 100000.0 AS a, l_quantity / 100.0 AS b, l_tax * 4 AS g,
         least(l_discount * 10, 1.0) AS w,
         l_orderkey % 40 AS r, CAST(l_linenumber AS BIGINT) AS c,
         CAST((l_orderkey + l_linenumber) % 12 AS INT) AS scl
  FROM lineitem
), ndvi AS (
  SELECT *, CASE WHEN a + b > 1e-6 THEN (a - b) / (a + b) END AS v FROM cells
)"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("field"),
        F.col("l_returnflag").alias("scene"),
        "l_orderkey",
        "l_partkey",
        (F.col("l_extendedprice") / 100000.0).alias("a"),
        (F.col("l_quantity") / 100.0).alias("b"),
        (F.col("l_tax") * 4).alias("g"),
        F.least(F.col("l_discount") * 10, F.lit(1.0)).alias("w"),
        (F.col("l_orderkey") % 40).alias("r"),
        F.col("l_linenumber").cast("long").alias("c"),
        ((F.col("l_orderkey") + F.col("l_linenumber")) % 12).cast("int").alias("scl"),
    )


def ndvi(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zonalith.functions.spectral import nd

    return cells(spark, sf_dir).withColumn("v", nd(F.col("a"), F.col("b")))


#: One row per observation: land, date, value 0..1, quality, source, id.
SERIES_SQL = """
series AS (
  SELECT user_id AS land, CAST(ts AS DATE) AS d, value / 500.0 AS v, (event_id % 100) / 100.0 AS q,
         event_type AS src, event_id AS id
  FROM events
)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("land"),
        F.col("ts").cast("date").alias("d"),
        (F.col("value") / 500.0).alias("v"),
        ((F.col("event_id") % 100) / 100.0).alias("q"),
        F.col("event_type").alias("src"),
        F.col("event_id").alias("id"),
    )


#: Ledger rows and land outcomes from orders.
LEDGER_SQL = """
ledger AS (
  SELECT o_custkey AS land_id, o_orderkey % 50 AS scene_id, 'fp' || CAST(o_custkey % 3 AS VARCHAR) AS geometry_fingerprint,
         CASE WHEN o_orderpriority < '3' THEN 'v3' ELSE 'v2' END AS pipeline_version,
         CASE WHEN o_orderstatus = 'F' THEN 'accepted' ELSE 'rejected' END AS outcome,
         CAST(o_orderdate AS DATE) AS acquisition_date, o_orderkey, o_totalprice
  FROM orders
), candidates AS (
  SELECT DISTINCT o_custkey AS land_id, o_orderkey % 50 AS scene_id, 'fp' || CAST(o_custkey % 3 AS VARCHAR) AS geometry_fingerprint
  FROM orders
)"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("land_id"),
        (F.col("o_orderkey") % 50).alias("scene_id"),
        F.concat(F.lit("fp"), (F.col("o_custkey") % 3).cast("string")).alias("geometry_fingerprint"),
        F.when(F.col("o_orderpriority") < "3", "v3").otherwise("v2").alias("pipeline_version"),
        F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("rejected").alias("outcome"),
        F.col("o_orderdate").cast("date").alias("acquisition_date"),
        "o_orderkey",
        "o_totalprice",
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(spark, sf_dir).select("land_id", "scene_id", "geometry_fingerprint").distinct()


#: Parcels: a square of 40 to 100 m around a point of a synthetic map, in metres and in degrees.
PARCELS_SQL = """
parcels AS (
  SELECT s_suppkey AS land, 400000.0 + (s_suppkey * 137) % 9000 AS px, 1900000.0 - (s_suppkey * 211) % 9000 AS py,
         40.0 + (s_suppkey % 7) * 10 AS side, 17.0 + (s_suppkey % 50) * 0.05 AS lat, 74.0 + (s_suppkey % 40) * 0.06 AS lon
  FROM supplier
)"""


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    p = table(spark, sf_dir, "supplier").select(
        k.alias("land"),
        (400000.0 + (k * 137) % 9000).alias("px"),
        (1900000.0 - (k * 211) % 9000).alias("py"),
        (40.0 + (k % 7) * 10).alias("side"),
        (17.0 + (k % 50) * 0.05).alias("lat"),
        (74.0 + (k % 40) * 0.06).alias("lon"),
    )
    x0, y0 = F.col("px"), F.col("py")
    x1, y1 = x0 + F.col("side"), y0 + F.col("side")
    point = lambda a, b: F.concat(F.lit("["), a.cast("string"), F.lit(","), b.cast("string"), F.lit("]"))
    ring = F.concat_ws(",", point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))
    return p.withColumn("geojson", F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}")))
