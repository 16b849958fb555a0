"""Queries over parcels: grouping, coverage, rings, blocks, images, variogram support, unmixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonalith.functions import geo, spectral as S
from zonalith.operators import geometry as G, raster, variogram
from zonalith.plans import bindings as B
from zonalith.plans.catalog import query


@query(f"WITH {B.PARCELS_SQL} SELECT land, CAST(floor((lon + 180.0) / 6.0) + 1 AS INT) AS zone, CAST(32600 + floor((lon + 180.0) / 6.0) + 1 AS INT) AS epsg, CAST((ceil(side / 10.0) + 1) * (ceil(side / 10.0) + 1) AS BIGINT) AS cells FROM parcels")
def utm_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ18, GE12."""
    p = B.parcels(spark, sf_dir)
    lat, lon, side = F.col("lat"), F.col("lon"), F.col("side")
    return p.select("land", geo.utm_zone(lon).alias("zone"), geo.utm_epsg(lat, lon).alias("epsg"), geo.bounding_cells(side, side).alias("cells"))


A1, B1 = 6378137.0, 1 / 298.257223563
N3 = B1 / (2 - B1)
RAD = A1 / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64)
AL = (N3 / 2 - 2 * N3**2 / 3 + 5 * N3**3 / 16, 13 * N3**2 / 48 - 3 * N3**3 / 5, 61 * N3**3 / 240)
EE = 2 * N3**0.5 / (1 + N3)


@query(
    f"""WITH {B.PARCELS_SQL}, z AS (SELECT *, floor((lon + 180.0) / 6.0) + 1 AS zone FROM parcels), t AS (SELECT *, sinh(atanh(sin(radians(lat))) - {EE} * atanh({EE} * sin(radians(lat)))) AS t, radians(lon - (zone * 6 - 183)) AS lam FROM z),
x AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t),
e AS (SELECT land, zone, 500000.0 + CAST(0.9996 * {RAD!r}e0 AS DOUBLE) * (eta + {AL[0]} * cos(2 * xi) * sinh(2 * eta) + {AL[1]} * cos(4 * xi) * sinh(4 * eta) + {AL[2]} * cos(6 * xi) * sinh(6 * eta)) AS e, CAST(0.9996 * {RAD!r}e0 AS DOUBLE) * (xi + {AL[0]} * sin(2 * xi) * cosh(2 * eta) + {AL[1]} * sin(4 * xi) * cosh(4 * eta) + {AL[2]} * sin(6 * xi) * cosh(6 * eta)) AS n FROM x)
SELECT 'utm' || CAST(CAST(zone AS INT) AS VARCHAR) || 'N:' || CAST(CAST(floor(e / 100000.0) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(floor(n / 100000.0) AS BIGINT) AS VARCHAR) AS spatial_group, count(*) AS lands, round(avg(e), 2) AS e, round(avg(n), 2) AS n FROM e GROUP BY 1"""
)
def spatial_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ19, GE9."""
    lat, lon = F.col("lat"), F.col("lon")
    e, n = geo.utm(lat, lon)
    p = B.parcels(spark, sf_dir).select(geo.spatial_group_key(lat, lon).alias("spatial_group"), e.alias("e"), n.alias("n"))
    return p.groupBy("spatial_group").agg(F.count("*").alias("lands"), F.round(F.avg("e"), 2).alias("e"), F.round(F.avg("n"), 2).alias("n"))


@query(
    f"""WITH {B.PARCELS_SQL}, g AS (SELECT land, px, py, px + side AS qx, py + side AS qy FROM parcels),
x AS (SELECT land, px, qx, py, qy, unnest(range(CAST(floor(px / 10) AS BIGINT), CAST(floor(qx / 10) AS BIGINT) + 1)) AS col FROM g), y AS (SELECT *, unnest(range(CAST(floor(-qy / 10) AS BIGINT), CAST(floor(-py / 10) AS BIGINT) + 1)) AS row FROM x),
w AS (SELECT land, row, col, greatest(0.0, least(qx, (col + 1) * 10.0) - greatest(px, col * 10.0)) * greatest(0.0, least(qy, -row * 10.0) - greatest(py, -(row + 1) * 10.0)) / 100.0 AS w FROM y)
SELECT land, count(*) AS n_cells, round(sum(w), 6) AS epc, round(sum(w) * 100, 3) AS area, count(*) FILTER (WHERE w >= 0.99) AS interior FROM w WHERE w >= 0.005 GROUP BY land"""
)
def coverage_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE3, JN6: exact coverage; the sum of coverage is the area."""
    c = G.cover_cells(B.parcels(spark, sf_dir), "land", "geojson")
    return c.groupBy("land").agg(F.count("*").alias("n_cells"), F.round(F.sum("coverage"), 6).alias("epc"), F.round(F.sum("coverage") * 100, 3).alias("area"), F.count_if(F.col("coverage") >= 0.99).alias("interior"))


@query(
    f"""WITH {B.PARCELS_SQL}, c AS (SELECT land, px, py, side, unnest(range(CAST(floor((px - 150) / 10) AS BIGINT), CAST(floor((px + side + 150) / 10) AS BIGINT) + 1)) AS col FROM parcels),
r AS (SELECT *, unnest(range(CAST(floor(-(py + side + 150) / 10) AS BIGINT), CAST(floor(-(py - 150) / 10) AS BIGINT) + 1)) AS row FROM c),
d AS (SELECT land, row, col, sqrt(pow(greatest(px - (col + 0.5) * 10, 0, (col + 0.5) * 10 - px - side), 2) + pow(greatest(py + (row + 0.5) * 10, 0, -(row + 0.5) * 10 - py - side), 2)) AS dist FROM r),
k AS (SELECT *, greatest(ceil(dist / 10.0) * 10.0, 20.0) AS ring FROM d WHERE dist >= 10 AND dist <= 150 AND (row * 31 + col * 17) % 7 = 0),
a AS (SELECT land, ring, count(*) AS n FROM k GROUP BY 1, 2), b AS (SELECT *, sum(n) OVER (PARTITION BY land ORDER BY ring) AS run FROM a), m AS (SELECT land, coalesce(min(CASE WHEN run >= 20 AND ring < 150 THEN ring END), 150.0) AS ring_m FROM b GROUP BY land)
SELECT k.land, max(ring_m) AS ring_m, count(*) AS n, CASE WHEN count(*) >= 20 THEN 'real' WHEN count(*) >= 3 THEN 'indicative' ELSE 'insufficient_context' END AS tier FROM k JOIN m ON k.land = m.land AND dist <= ring_m GROUP BY k.land"""
)
def neighbour_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN7, WN10, GE8, CD5: the smallest ring with enough clean neighbour cells."""
    c = G.ring_cells(B.parcels(spark, sf_dir), "land", "geojson").where("(row * 31 + col * 17) % 7 = 0")
    r = G.ring_width(c, "land", "distance")
    return r.groupBy("land").agg(F.max("ring_m").cast("double").alias("ring_m"), F.count("*").alias("n"), G.ring_tier(F.count("*")).alias("tier"))


@query(
    f"""WITH {B.PARCELS_SQL}, b AS (SELECT land, land % 23 = 0 AS own, CAST(floor((lon + lon + 0.001) / 2 * (111320.0 * cos(radians(18.0))) / 5000.0) AS BIGINT) AS block_x, CAST(floor((lat + lat + 0.001) / 2 * 110540.0 / 5000.0) AS BIGINT) AS block_y FROM parcels)
SELECT land, own, CASE WHEN own THEN 0 ELSE CAST(floor((row_number() OVER (PARTITION BY own, block_x, block_y ORDER BY CAST(land AS VARCHAR)) - 1) / 2) AS INT) END AS chunk FROM b"""
)
def block_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE11: blocks of at most two lands, larger parcels alone."""
    wide = F.when(F.col("land") % 23 == 0, 0.5).otherwise(0.0)
    p = B.parcels(spark, sf_dir).select("land", (F.col("lon") - wide).alias("x0"), F.col("lat").alias("y0"), (F.col("lon") + wide + 0.001).alias("x1"), (F.col("lat") + 0.001).alias("y1"))
    out = G.plan_blocks(p, "land", "x0", "y0", "x1", "y1", 18.0, most=2)
    return out.select("land", "own", F.when(F.col("own"), 0).otherwise(F.col("chunk")).alias("chunk"))


@query(
    f"""WITH {B.PARCELS_SQL}, s AS (SELECT l_orderkey AS scene, CASE WHEN l_orderkey % 5 > 0 THEN 400000.0 + l_partkey % 9000 END AS x0, 1891000.0 + l_suppkey * 53 % 9000 AS y0 FROM lineitem WHERE l_linenumber = 1)
SELECT land, scene FROM parcels, (SELECT DISTINCT * FROM s) s WHERE land % 3 = scene % 3 AND (x0 IS NULL OR (px <= x0 + 2000 AND x0 <= px + side AND py <= y0 + 2000 AND y0 <= py + side))"""
)
def scene_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN4, GE10: scenes that meet a parcel of their group; those without a footprint are kept."""
    li = B.table(spark, sf_dir, "lineitem").where("l_linenumber = 1")
    x0, y0 = F.when(F.col("l_orderkey") % 5 > 0, 400000.0 + F.col("l_partkey") % 9000), 1891000.0 + F.col("l_suppkey") * 53 % 9000
    s = li.select(F.col("l_orderkey").alias("scene"), (F.col("l_orderkey") % 3).alias("g"), x0.alias("x0"), y0.alias("y0"), (x0 + 2000).alias("x1"), (y0 + 2000).alias("y1")).distinct()
    p = B.parcels(spark, sf_dir).select("land", (F.col("land") % 3).alias("g"), F.col("px").alias("x0"), F.col("py").alias("y0"), (F.col("px") + F.col("side")).alias("x1"), (F.col("py") + F.col("side")).alias("y1"))
    return G.box_join(p, s, ["g"], 2000.0).select("land", "scene")


@query(
    """SELECT l_orderkey, l_partkey, 't' || CAST(l_suppkey AS VARCHAR) || '/' || CAST(l_partkey AS VARCHAR) || '/' || strftime(l_shipdate, '%Y-%m-%d') || '_' || 'S2_' || l_returnflag || '_x_zones.png' AS path,
  CASE WHEN v < 0.25 THEN 1 WHEN v > 0.35 THEN 3 ELSE 2 END AS zone, round(greatest(0.0, least(1.0, (v - 0.1) / 0.6)), 6) AS stretched FROM (SELECT *, l_tax * 8 AS v FROM lineitem) t"""
)
def image_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK12, PRJ34, PRJ36."""
    v = F.col("l_tax") * 8
    li = B.table(spark, sf_dir, "lineitem")
    path = geo.image_path(F.concat(F.lit("t"), F.col("l_suppkey").cast("string")), F.col("l_partkey").cast("string"), F.col("l_shipdate"), F.concat(F.lit("S2/"), "l_returnflag", F.lit(".x")), "_zones")
    return li.select("l_orderkey", "l_partkey", path.alias("path"), geo.zone_class(v, F.lit(0.3)).cast("int").alias("zone"), F.round(geo.stretch(v, F.lit(0.1), F.lit(0.7)), 6).alias("stretched"))


@query(
    """WITH s AS (SELECT user_id AS u, CASE event_id % 4 WHEN 0 THEN '2024-01-05T10:00:00Z' WHEN 1 THEN '2024-01-06' WHEN 2 THEN '2024-01-07 not a time' ELSE 'none' END AS t, CASE event_id % 3 WHEN 0 THEN 'HTTP 429 Too Many Requests' WHEN 1 THEN 'Read timeout' ELSE 'bad value' END AS m, event_id FROM events)
SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN DATE '2024-01-05' WHEN 1 THEN DATE '2024-01-06' WHEN 2 THEN DATE '2024-01-07' END AS d, CASE event_id % 3 WHEN 0 THEN 'rate_limited' WHEN 1 THEN 'server_or_timeout' ELSE 'other' END AS class, event_id % 3 = 1 AS transient FROM s"""
)
def text_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ37, PRJ38, SNK11."""
    from zonalith.functions.evidence import error_class, transient

    k = F.col("event_id")
    t = F.when(k % 4 == 0, "2024-01-05T10:00:00Z").when(k % 4 == 1, "2024-01-06").when(k % 4 == 2, "2024-01-07 not a time").otherwise("none")
    m = F.when(k % 3 == 0, "HTTP 429 Too Many Requests").when(k % 3 == 1, "Read timeout").otherwise("bad value")
    return B.table(spark, sf_dir, "events").select(k.alias("id"), geo.parse_date(t).alias("d"), error_class(m).alias("class"), transient(m).alias("transient"))


@query()
def rendered_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE14, PRJ33, SNK8."""
    c = B.cells(spark, sf_dir).groupBy("field", F.col("r").alias("row"), F.col("c").alias("col")).agg(F.avg(S.nd(F.col("a"), F.col("b"))).alias("value"))
    return raster.render(c, ["field"]).select("field", "width", "height", F.octet_length("png").alias("bytes"))


@query(
    """WITH g AS (SELECT l_suppkey AS field, l_orderkey % 12 AS r, CAST(l_linenumber AS BIGINT) AS c, avg(l_tax * 8) AS v, least(max(l_discount) * 10, 1.0) AS w FROM lineitem GROUP BY 1, 2, 3), ok AS (SELECT * FROM g WHERE w > 0),
p AS (SELECT a.field, sqrt((b.r - a.r) * (b.r - a.r) + (b.c - a.c) * (b.c - a.c)) AS d, 0.5 * (b.v - a.v) * (b.v - a.v) AS y FROM ok a JOIN ok b ON a.field = b.field AND (a.r < b.r OR (a.r = b.r AND a.c < b.c))),
q AS (SELECT field, quantile_cont(y, 0.9) AS sill, quantile_cont(d, 0.25) AS near FROM p GROUP BY field), n AS (SELECT p.field, quantile_cont(y, 0.1) AS nugget FROM p JOIN q ON p.field = q.field AND d <= near GROUP BY p.field),
t AS (SELECT p.field, greatest(min(CASE WHEN y >= nugget + 0.95 * greatest(sill - nugget, 0.0) THEN d END), 1.0) AS rng, max(sill) AS sill, max(nugget) AS nugget FROM p JOIN q ON p.field = q.field JOIN n ON n.field = p.field GROUP BY p.field),
k AS (SELECT field, sum(w) AS epc, sum(w) * sum(w) / sum(w * w) AS kish FROM ok GROUP BY field)
SELECT k.field, round(rng, 4) AS range_cells, round(sill, 6) AS sill, round(nugget, 6) AS nugget, round(greatest(1.0, least(kish, epc / (pi() * rng * rng))), 4) AS n_eff FROM k JOIN t ON k.field = t.field"""
)
def variogram_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG15."""
    li = B.table(spark, sf_dir, "lineitem")
    g = li.groupBy(F.col("l_suppkey").alias("field"), (F.col("l_orderkey") % 12).alias("r"), F.col("l_linenumber").cast("long").alias("c")).agg(F.avg(F.col("l_tax") * 8).alias("v"), F.least(F.max("l_discount") * 10, F.lit(1.0)).alias("w"))
    out = variogram.support(g, "field", "r", "c", "v", "w")
    return out.select("field", F.round("range_cells", 4).alias("range_cells"), F.round("sill", 6).alias("sill"), F.round("nugget", 6).alias("nugget"), F.round("n_eff", 4).alias("n_eff"))


@query(
    """WITH e AS (SELECT k, 0.1 + 0.01 * k AS c, 0.5 - 0.005 * k AS s FROM range(64) r(k)), m AS (SELECT sum(CAST(c * c AS DOUBLE)) AS cc, sum(CAST(s * s AS DOUBLE)) AS ss, sum(CAST(c * s AS DOUBLE)) AS cs FROM e),
v AS (SELECT vec_id, unnest(range(64)) AS k, abs(CAST(unnest(embedding) AS DOUBLE)) AS b FROM embeddings),
p AS (SELECT vec_id, sum(b * c) AS bc, sum(b * s) AS bs, sum(b * b) AS bb FROM v JOIN e ON v.k = e.k GROUP BY vec_id),
x AS (SELECT vec_id, bb, bc, bs, cc, ss, cs, (bc * ss - bs * cs) / (cc * ss - cs * cs) AS x1, (bs * cc - bc * cs) / (cc * ss - cs * cs) AS x2 FROM p, m),
y AS (SELECT *, CASE WHEN x1 >= 0 AND x2 >= 0 THEN x1 WHEN bc > 0 AND bc * bc / cc >= CASE WHEN bs > 0 THEN bs * bs / ss ELSE 0 END THEN bc / cc ELSE 0 END AS y1,
  CASE WHEN x1 >= 0 AND x2 >= 0 THEN x2 WHEN bc > 0 AND bc * bc / cc >= CASE WHEN bs > 0 THEN bs * bs / ss ELSE 0 END THEN 0 WHEN bs > 0 THEN bs / ss ELSE 0 END AS y2 FROM x)
SELECT vec_id, round(y1 / nullif(y1 + y2, 0), 6) AS crop, round(y2 / nullif(y1 + y2, 0), 6) AS soil, round(sqrt(greatest(bb - 2 * (y1 * bc + y2 * bs) + y1 * y1 * cc + 2 * y1 * y2 * cs + y2 * y2 * ss, 0) / 64), 6) AS rmse FROM y"""
)
def unmixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE13."""
    e = B.table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.abs(x).cast("double")).alias("s"))
    out = G.unmix(e, "s", {"crop": [0.1 + 0.01 * k for k in range(64)], "soil": [0.5 - 0.005 * k for k in range(64)]})
    return out.select("vec_id", *[F.round(c, 6).alias(c) for c in ("crop", "soil", "rmse")])


POINT = lambda x, y: f"format('{{:.7f}} {{:.7f}}', {x}, {y})"


@query(
    f"""WITH {B.PARCELS_SQL}, q AS (SELECT *, px + side AS qx, py + side AS qy FROM parcels)
SELECT land, CASE WHEN land % 3 = 0 THEN 'high' WHEN land % 3 = 1 THEN 'medium' WHEN land % 2 = 0 THEN 'low' END AS confidence, CASE WHEN land % 3 < 2 THEN 5 WHEN land % 2 = 0 THEN 65 END AS points,
CASE WHEN land % 3 < 2 THEN substr(sha1(concat_ws(',', {POINT('px', 'py')}, {POINT('qx', 'py')}, {POINT('qx', 'qy')}, {POINT('px', 'qy')}, {POINT('px', 'py')})), 1, 16) END AS fingerprint FROM q"""
)
def geometry_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE1, PRJ20: the first usable boundary, its confidence and the fingerprint of stored ones; a land without either has none."""
    p, k = B.parcels(spark, sf_dir), F.col("land") % 3
    lat = F.when(F.col("land") % 2 == 0, F.col("lat"))
    g = G.resolve_geometry([F.when(k == 0, F.col("geojson")).otherwise('{"type":"Point"}')], F.when(k == 1, F.col("geojson")), lat, F.col("lon"))
    raw = F.from_json(g["geojson"], "coordinates array<array<array<double>>>")["coordinates"]
    rings = F.transform(raw, lambda ring: F.transform(ring, lambda x: F.struct(x[0].alias("x"), x[1].alias("y"))))
    word = g["confidence"]
    return p.select("land", word.alias("confidence"), F.size(raw[0]).alias("points"), F.when(word != "low", geo.fingerprint(rings)).alias("fingerprint"))
