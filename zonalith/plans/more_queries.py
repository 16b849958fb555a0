"""Further queries: rounding, colours, grids, logs, raster tiles, erosion, buffers, the whole measurement, a stream."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from zonalith import constants as C
from zonalith.functions import geo, spectral as S
from zonalith.operators import geometry as G, raster, stats
from zonalith.plans import bindings as B, pipeline
from zonalith.plans.catalog import query
from zonalith.session import new_path
from zonalith.streaming import observations as O


@query("SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN round((o_custkey % 1000) / 7.0, 3) WHEN 2 THEN NULL ELSE round(o_totalprice / 3, 3) END AS x FROM orders")
def safe_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ15: text that is no number, NaN and infinity are missing."""
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, "n/a").when(k == 1, (F.col("o_custkey") % 1000 / 7.0).cast("string")).when(k == 2, "NaN").otherwise((F.col("o_totalprice") / 3).cast("string"))
    return B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), S.safe_round(raw, 3).alias("x"))


@query(
    f"""WITH {B.PARCELS_SQL}, r AS (SELECT land, side * 0.00001 * cos(radians(lat)) / (0.00001 * (30 + land % 60)) AS ratio FROM parcels)
SELECT land, greatest(64, CAST(round(CASE WHEN ratio >= 1 THEN 512.0 ELSE 512 * ratio END) AS INT)) AS w, greatest(64, CAST(round(CASE WHEN ratio >= 1 THEN 512 / ratio ELSE 512.0 END) AS INT)) AS h FROM r"""
)
def image_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ35."""
    g = geo.image_grid(F.col("side") * 0.00001, 0.00001 * (30 + F.col("land") % 60), F.col("lat"))
    return B.parcels(spark, sf_dir).select("land", g["w"].cast("int").alias("w"), g["h"].cast("int").alias("h"))


@query("SELECT CASE WHEN v <= -0.2 THEN 'low' WHEN v >= 1 THEN 'high' ELSE 'ramp' END AS part, count(*) AS n, min(r) AS r0, max(r) AS r1 FROM (SELECT v, CASE WHEN v <= -0.2 THEN 124 WHEN v >= 1 THEN 27 ELSE 100 END AS r FROM (SELECT l_linenumber * 0.4 - 0.7 AS v FROM lineitem) t WHERE v <= -0.2 OR v >= 1) u GROUP BY 1")
def ramp_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ33: values beyond the ramp take its end colours."""
    v = F.col("l_linenumber") * 0.4 - 0.7
    li = B.table(spark, sf_dir, "lineitem").select(v.alias("v"), geo.ramp_color(v)["r"].alias("r")).where("v <= -0.2 or v >= 1")
    return li.groupBy(F.when(F.col("v") <= -0.2, "low").when(F.col("v") >= 1, "high").otherwise("ramp").alias("part")).agg(F.count("*").alias("n"), F.min("r").alias("r0"), F.max("r").alias("r1"))


@query("SELECT user_id AS land, list_aggregate(list_slice(list(event_id ORDER BY event_id), 1, 6), 'sum') AS first_six, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY user_id")
def first_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SO4: the first six of a list."""
    ev = B.table(spark, sf_dir, "events").where("event_type = 'error'")
    # The six smallest by rank, so that no list of a whole group is made.
    w = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    ranked = ev.select(F.col("user_id").alias("land"), "event_id", w.alias("k"))
    return ranked.groupBy("land").agg(F.sum(F.when(F.col("k") <= 6, F.col("event_id"))).alias("first_six"), F.count("*").alias("n"))


@query("SELECT event_type AS step, CASE WHEN event_id % 10 = 0 THEN 'failed' ELSE 'completed' END AS status, count(*) AS n, CAST(sum(event_id % 5000) AS BIGINT) AS duration_ms FROM events GROUP BY 1, 2")
def processing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6: log rows by step and status."""
    k = F.col("event_id")
    log = B.table(spark, sf_dir, "events").select(F.col("event_type").alias("step"), F.when(k % 10 == 0, "failed").otherwise("completed").alias("status"), (k % 5000).alias("ms"))
    return log.groupBy("step", "status").agg(F.count("*").alias("n"), F.sum("ms").alias("duration_ms"))


def tiles(spark: SparkSession, sf_dir: str, size: int = 16) -> DataFrame:
    """Synthetic raster tiles, one for each nation: value of a cell is (row * 7 + col * 3) % 50 / 50."""

    def make(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                i, j = np.indices((size, size))
                i, j = i + (k // 5) * size, j + (k % 5) * size
                v = ((i * 7 + j * 3) % 50 / 50.0).astype("<f4")
                yield pa.RecordBatch.from_pydict({"scene_id": ["s"], "band": ["b04"], "row0": [int(i[0, 0])], "col0": [int(j[0, 0])], "h": pa.array([size], pa.int32()), "w": pa.array([size], pa.int32()), "data": [v.tobytes()]})

    return B.table(spark, sf_dir, "nation").select("n_nationkey").mapInArrow(make, raster.TILE)


CELL = "SELECT r AS row, c AS col, CAST(CAST(((r * 7 + c * 3) % 50) / 50.0 AS FLOAT) AS DOUBLE) AS v FROM range(80) r(r), range(80) c(c)"


@query(f"SELECT count(*) AS n, round(sum(v), 4) AS total, min(row) AS r0, max(col) AS c1 FROM ({CELL}) t WHERE row BETWEEN 10 AND 40 AND col BETWEEN 20 AND 60")
def raster_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC8, SRC9: a windowed read that decodes only the tiles it meets."""
    w = raster.window(tiles(spark, sf_dir), 10, 20, 41, 61)
    return w.agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("double")), 4).alias("total"), F.min("row").alias("r0"), F.max("col").alias("c1"))


@query(f"SELECT n_nationkey AS land_id, count(*) AS n, round(avg(v), 6) AS mean FROM nation JOIN ({CELL}) t ON row >= n_nationkey * 2 AND row < n_nationkey * 2 + 9 AND col >= n_nationkey AND col < n_nationkey + 13 GROUP BY n_nationkey")
def parcel_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10, JN18: every parcel's cells from one scan of the scene."""
    k = F.col("n_nationkey").cast("long")
    p = B.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("land_id"), (k * 2).alias("r0"), k.alias("c0"), (k * 2 + 9).alias("r1"), (k + 13).alias("c1"))
    c = raster.block_subset(raster.cells_of(tiles(spark, sf_dir)), p, 16)
    return c.groupBy("land_id").agg(F.count("*").alias("n"), F.round(F.avg(F.col("value").cast("double")), 6).alias("mean"))


@query(f"SELECT count(*) * 4 AS n, round(sum(v) * 4, 4) AS total, 159 AS r1 FROM ({CELL}) t")
def regrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE6: 20 m to 10 m, nearest."""
    f = raster.regrid_nearest(raster.cells_of(tiles(spark, sf_dir)))
    return f.agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("double")), 4).alias("total"), F.max("row").cast("int").alias("r1"))


@query(
    f"""WITH t AS ({CELL}), o AS (SELECT * FROM (VALUES (-1, 0.25e0), (0, 0.75e0), (1, 0.75e0), (2, 0.25e0)) o(d, s)),
f AS (SELECT row * 2 + a.d AS r, col * 2 + b.d AS c, sum(v * a.s * b.s) / sum(a.s * b.s) AS v FROM t, o a, o b GROUP BY 1, 2 HAVING r BETWEEN 0 AND 159 AND c BETWEEN 0 AND 159)
SELECT r // 16 AS band_row, count(*) AS n, round(sum(v), 4) AS total, round(min(v), 6) AS lowest, round(sum(v * c), 2) AS moment FROM f GROUP BY 1"""
)
def regrid_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE6: 20 m to 10 m, bilinear, over the neighbours that are there."""
    cells = raster.cells_of(tiles(spark, sf_dir)).withColumn("value", F.col("value").cast("double"))
    f = raster.regrid_bilinear(cells, ["scene_id", "band"])
    v = F.col("value")
    return f.groupBy(F.floor(F.col("row") / 16).alias("band_row")).agg(F.count("*").alias("n"), F.round(F.sum(v), 4).alias("total"), F.round(F.min(v), 6).alias("lowest"), F.round(F.sum(v * F.col("col")), 2).alias("moment"))


def _ramp_sql(channel: int) -> str:
    """The colour at x, piecewise linear between the stops."""
    stops = [(x, int(h[1 + 2 * channel : 3 + 2 * channel], 16)) for x, h in C.COLOR_STOPS]
    parts = [f"WHEN x <= {b}e0 THEN {ra} + (x - {a}e0) / ({b}e0 - {a}e0) * {rb - ra}" for (a, ra), (b, rb) in zip(stops, stops[1:])]
    return f"CAST(round_even(CASE {' '.join(parts)} ELSE {stops[-1][1]} END, 0) AS INT)"


LOW, HIGH = C.COLOR_STOPS[0][0], C.COLOR_STOPS[-1][0]


@query(
    f"""WITH s AS (SELECT o_orderkey AS id, greatest({LOW}e0, least({HIGH}e0, CAST(o_orderkey % 1500 AS DOUBLE) / 1000e0 - 0.35e0)) AS v FROM orders),
x AS (SELECT id, {LOW}e0 + round_even((v - {LOW}e0) / ({HIGH - LOW!r}e0) * 511, 0) * ({HIGH - LOW!r}e0 / 511) AS x FROM s)
SELECT id, {_ramp_sql(0)} AS r, {_ramp_sql(1)} AS g, {_ramp_sql(2)} AS b FROM x"""
)
def ramp_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ33: the whole ramp."""
    c = geo.ramp_color((F.col("o_orderkey") % 1500).cast("double") / 1000.0 - 0.35)
    return B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), *[c[n].alias(n) for n in "rgb"])


@query(
    f"""WITH {B.PARCELS_SQL} SELECT land, round(CAST(CASE WHEN side * side < 5000 OR (side - 20) * (side - 20) < 400 THEN side * side ELSE (side - 20) * (side - 20) END AS DOUBLE), 3) AS area, side * side >= 5000 AND (side - 20) * (side - 20) >= 400 AS eroded,
  round(CASE WHEN side * side >= 20000 THEN CAST(0 AS DOUBLE) ELSE (-4 * side + sqrt(16 * side * side - 4 * pi() * (side * side - 20000))) / (2 * pi()) END, 2) AS buffer FROM parcels"""
)
def field_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE2, GE7: adaptive erosion, and the buffer that brings a field to 2 ha."""

    def run(batches):
        for batch in batches:
            land, area, done, buffer = [], [], [], []
            for k, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rings = G.rings_of(g)
                small, eroded, _ = G.erode(rings)
                land.append(k)
                area.append(round(G.area(small), 3))
                done.append(eroded)
                buffer.append(round(G.context_buffer(rings, 20_000.0), 2))
            yield pa.RecordBatch.from_pydict({"land": land, "area": area, "eroded": done, "buffer": buffer})

    return B.parcels(spark, sf_dir).select("land", "geojson").mapInArrow(run, "land long, area double, eroded boolean, buffer double")


def _measured(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cells, lands, and the date of each scene."""
    c = B.cells(spark, sf_dir)
    cells = c.select(F.col("field").alias("land_id"), F.col("scene").alias("scene_id"), F.col("w").alias("coverage"), "scl", F.col("a").alias("b08"), (F.col("b") / 4).alias("b04"), F.col("g").alias("b03"), (F.col("b") / 2).alias("b11"), (F.col("g") / 2).alias("b02"))
    lands = B.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("land_id"), F.lit("t").alias("tenant_id"), (F.col("s_suppkey") % 5 / 2.0).alias("acres"), F.when(F.col("s_suppkey") % 3 == 0, "low").otherwise("high").alias("geometry_confidence"), (F.col("s_suppkey") % 2 == 0).alias("buffered"))
    scenes = B.table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("scene_id")).agg(F.max(F.col("l_shipdate").cast("date")).alias("acquisition_date"))
    return cells, lands, scenes


@query()
def measured_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CD1, CD4, CD8: cells to graded observations by their real classes, split, given context and promoted. A land's context is the
    crop cells of the lands numbered next to it."""
    cells, lands, scenes = _measured(spark, sf_dir)
    v = stats.crop_mask(S.nd(F.col("b08"), F.col("b04")), F.col("scl"))
    near = cells.select(F.explode(F.array(F.col("land_id") - 1, F.col("land_id") + 1)).alias("land_id"), "scene_id", v.alias("v"), F.lit(1.0).alias("one"))
    ring = stats.context_summary(near, pipeline.KEYS, "v", "one").select(*pipeline.KEYS, "median", "mad", "n_cells", G.ring_tier(F.col("n_cells")).alias("tier"))
    return pipeline.observe(cells, lands, ring, scenes)


@query()
def radar_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CD3, JN5: the newest pass of each land, measured by radar."""
    cells, lands, scenes = _measured(spark, sf_dir)
    newest = pipeline.newest_pass(cells.select(*pipeline.KEYS).distinct().join(scenes, "scene_id"))
    own = cells.join(newest, pipeline.KEYS, "left_semi").withColumnsRenamed({"b08": "vv", "b04": "vh"})
    return pipeline.measure_radar(own, lands)


@query("SELECT user_id AS land, CAST(ts AS DATE) AS day, count(*) AS n, max(event_id) AS last FROM events GROUP BY 1, 2")
def streamed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SM1, SM2, SM7: the events as a stream, upserted by land and day until all is read."""
    schema = B.table(spark, sf_dir, "events").schema
    stream = O.bounded_source(spark, sf_dir, schema, name="events.parquet")
    out = new_path(spark, "stream")
    sink = O.upsert_sink(f"{out}/table", ["land", "day"], ["last"])

    def write(batch: DataFrame, number: int) -> None:
        sink(batch.groupBy(F.col("user_id").alias("land"), F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"), F.max("event_id").alias("last")), number)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return O.current(spark, f"{out}/table").select("land", "day", "n", "last")
