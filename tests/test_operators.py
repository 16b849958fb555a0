"""Operators on small fixtures: statistics, series, state machine, geometry, raster, validation."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from zonalith.operators import geometry as G, incremental as I, raster, rules, stats, temporal as T, validation as V, variogram, zones
from zonalith.plans import pipeline


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_weighted_stats_golden(spark):
    rows = [("f", 0.75, 1.0), ("f", 0.75, 1.0), *[("f", 0.10, 0.25)] * 6, ("f", None, 1.0), ("f", 0.3, 0.0)]
    s = stats.weighted_stats(frame(spark, rows, "k string, v double, w double"), ["k"], "v", "w").first()
    assert (s.epc, s.n_cells, s.purity) == (3.5, 8, 0.4375) and s["mean"] > 0.4


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.floats(-1, 1), st.floats(0.01, 1)), min_size=1, max_size=20), st.floats(0.1, 10))
def test_weighted_stats_properties(spark, cells, scale):
    rows = [("a", v, w) for v, w in cells] + [("b", v, w * scale) for v, w in cells]
    got = {r.k: r for r in stats.weighted_stats(frame(spark, rows, "k string, v double, w double"), ["k"], "v", "w").collect()}
    a, b = got["a"], got["b"]
    for c in ("mean", "std", "p10", "median", "p90", "n_eff"):
        assert a[c] == pytest.approx(b[c], rel=1e-6, abs=1e-6)
    assert 0 < a.n_eff <= a.n_cells + 1e-9 and 0 < a.purity <= 1 + 1e-9
    v, w = np.array([c[0] for c in cells]), np.array([c[1] for c in cells])
    order = np.lexsort((w, v))
    q = (np.cumsum(w[order]) - w[order] / 2) / w.sum()
    assert a.median == pytest.approx(np.interp(0.5, q, v[order]), abs=1e-9)


def test_equal_weights_equal_unweighted(spark):
    df = frame(spark, [("k", float(x), 1.0) for x in (1, 2, 4, 8)], "k string, v double, w double")
    a, b = stats.weighted_stats(df, ["k"], "v", "w").first(), stats.unweighted_stats(df, ["k"], "v").first()
    assert a["mean"] == b["mean"] and a["std"] == pytest.approx(b["std"])


def test_histogram_edges(spark):
    edges = np.linspace(-1, 1, 21)
    values = [*edges.tolist(), -1.0001, 1.0001, 0.33]
    got = frame(spark, [(float(v),) for v in values], "v double").select(stats.bin_index(F.col("v"), -1.0, 1.0, 20).alias("b")).collect()
    assert [r.b for r in got][:-3] == [*range(20), 19] and got[-3].b is None and got[-2].b is None


def test_robust_location(spark):
    df = frame(spark, [("k", 0.2, 1.0), ("k", 0.3, 2.0), ("k", 0.4, 1.0)], "k string, v double, w double")
    r = stats.robust_location(df, ["k"], "v", "w").first()
    assert (r["median"], r["mad"]) == (0.3, 0.0)


FORECAST = [("08-20", 0.30), ("08-25", 0.36), ("08-30", 0.42), ("09-04", 0.47), ("09-09", 0.52)]


def series(spark, points, q=0.9):
    return frame(spark, [("l", dt.date.fromisoformat(f"2026-{d}"), v, q, k) for k, (d, v) in enumerate(points)], "land string, d date, v double, q double, id long")


def test_forecast(spark):
    out = T.forecast(series(spark, FORECAST), "land", "d", "v", "q", "id").orderBy("horizon_days").collect()
    assert [str(r.date) for r in out] == [f"2026-09-{d}" for d in range(10, 15)]
    assert all(r.low <= r.estimated <= r.high for r in out) and out[0].training_count == 5
    for refused in (FORECAST[:2], [*FORECAST[:4], ("09-18", 0.5)], [(d, v) for d, v in FORECAST[:1]] * 3):
        assert T.forecast(series(spark, refused), "land", "d", "v", "q", "id").count() == 0
    assert T.forecast(series(spark, FORECAST, 0.5), "land", "d", "v", "q", "id").count() == 0


def test_trend(spark):
    r = T.trend(series(spark, FORECAST), "land", "d", "v", "id").first()
    assert r.direction == "sharp_improving" and r.slope_per_day == pytest.approx(0.0110, abs=2e-4) and r.n_points == 5
    r = T.trend(series(spark, [("06-01", 0.1), ("07-01", 0.2), ("08-01", 0.3)]), "land", "d", "v", "id").first()
    assert r.n_points == 3 and r.span_days == 61.0
    assert T.trend(series(spark, FORECAST[:2]), "land", "d", "v", "id").first().direction == "insufficient_data"


def test_five_nights(spark):
    """Full run, quiet night, new scene, late old scene, changed boundary."""
    cand = lambda rows: frame(spark, rows, "land_id string, scene_id string, geometry_fingerprint string")
    day = dt.date(2026, 9, 1)
    led = lambda rows: frame(spark, [(*r, "v3", day) for r in rows], "land_id string, scene_id string, geometry_fingerprint string, outcome string, pipeline_version string, acquisition_date date")
    since = F.lit("2026-08-01").cast("date")
    names = lambda df: sorted((r.land_id, r.scene_id) for r in df.collect())
    first = cand([(l, s, "f1") for l in ("L1", "L2") for s in ("A", "B")])
    assert len(names(I.unseen(first, led([]), "v3", since))) == 4
    known = led([(l, s, "f1", o) for l in ("L1", "L2") for s, o in (("A", "accepted"), ("B", "rejected"))])
    assert names(I.unseen(first, known, "v3", since)) == [] and I.unchanged_lands(first, known, "v3", since).count() == 2
    assert len(names(I.unseen(first, known, "v4", since))) == 4
    new = first.unionByName(cand([("L1", "C", "f1"), ("L2", "C", "f1")]))
    todo = I.unseen(new, known, "v3", since)
    assert names(todo) == [("L1", "C"), ("L2", "C")] and I.needed_scenes(todo).count() == 1
    edited = cand([("L1", "A", "f2"), ("L2", "A", "f1")])
    assert names(I.unseen(edited, known, "v3", since)) == [("L1", "A")]
    cur = frame(spark, [("L1", dt.date(2026, 9, 5), 0.5)], "land string, d date, v double")
    late = frame(spark, [("L1", dt.date(2026, 9, 1), 0.9), ("L2", dt.date(2026, 9, 1), 0.3)], "land string, d date, v double")
    assert {(r.land, r.v) for r in I.snapshot_forward(cur, late, "land", "d").collect()} == {("L1", 0.5), ("L2", 0.3)}


def test_merge_is_idempotent(spark):
    t = frame(spark, [(1, "a"), (2, "b")], "id long, v string")
    s = frame(spark, [(2, "c"), (3, "d")], "id long, v string")
    once = I.merge_upsert(t, s, ["id"])
    twice = I.merge_upsert(once, s, ["id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_snapshot_needs_value(spark):
    lands = frame(spark, [("1", 0.1, False, "s", "n", None)], "id string, value double, tested boolean, status string, note string, thumbnail string")
    u = frame(spark, [("1", True, None, None, False, None, None)], "id string, has_snapshot boolean, value double, status string, set_note boolean, note string, thumbnail string")
    with pytest.raises(Exception, match="a snapshot needs a value"):
        I.apply_updates(lands, u).collect()


def test_exit_codes():
    assert [I.exit_code(0, 5, 0), I.exit_code(0, 0, 0), I.exit_code(4, 0, 1), I.exit_code(4, 0, 0)] == [0, 2, 3, 0]


def quarter_cells(spark, value):
    rows = [("f", r, c, 1.0, value(r, c), 0.3, value(r, c)) for r in range(8) for c in range(8)]
    return frame(spark, rows, "k string, r int, c int, w double, ndvi double, ndre double, ndmi double")


def zone(spark, value, prev=None, level=None, median=0.70, se=0.01):
    q = zones.quarters(quarter_cells(spark, value), "k", "r", "c", "w", "w", {"ndvi": "ndvi", "ndre": "ndre", "ndmi": "ndmi"})
    f = frame(spark, [("f", median, se, "high", prev, level, None, None)], "k string, median double, se double, evidence string, prev_weakest string, prev_level string, prev_water_weakest string, prev_water_level string")
    return zones.assess(q, f, "k").first()


def test_zones(spark):
    weak = lambda r, c: 0.55 if r >= 4 and c >= 4 else 0.70
    z = zone(spark, weak)
    assert (z.weakest, z.level, z.reason, z.water_weakest, z.water_level) == ("SE", "watch", "gap_one_pass", "SE", "watch")
    assert zone(spark, weak, "SE", "watch").level == "check"
    assert zone(spark, lambda r, c: 0.7).reason == "gap_within_noise"
    small = quarter_cells(spark, weak).where("r < 2 and c < 1")
    q = zones.quarters(small, "k", "r", "c", "w", "w", {"ndvi": "ndvi", "ndre": "ndre", "ndmi": "ndmi"})
    f = frame(spark, [("f", 0.7, 0.01, "high", None, None, None, None)], "k string, median double, se double, evidence string, prev_weakest string, prev_level string, prev_water_weakest string, prev_water_level string")
    assert zones.assess(q, f, "k").first().reason == "field_too_small"


def square(x0, y0, x1, y1):
    return f'{{"type":"Polygon","coordinates":[[[{x0},{y0}],[{x1},{y0}],[{x1},{y1}],[{x0},{y1}],[{x0},{y0}]]]}}'


SHAPES = [
    [(0, 0), (61, 0), (61, 41), (0, 41)],
    [(3, 2), (90, 20), (70, 80), (10, 60)],
    [(0, 0), (100, 0), (100, 100), (50, 40), (0, 100)],
    [(0, 0), (120, 3), (120, 8), (0, 5)],
]


@pytest.mark.parametrize("points", SHAPES)
def test_coverage_is_area(points):
    rings = [np.array(points, float) + 1000.3]
    x0, y0 = 990.0, 1120.0
    w = G.coverage(rings, x0, y0, 10.0, 14, 14)
    assert w.sum() * 100 == pytest.approx(G.area(rings), rel=2e-3) and w.max() <= 1


def test_coverage_with_hole():
    rings = [np.array([(0, 0), (50, 0), (50, 50), (0, 50)], float), np.array([(20, 20), (30, 20), (30, 30), (20, 30)], float)]
    assert G.coverage(rings, 0, 50, 10.0, 5, 5).sum() == pytest.approx(24.0)


def test_erosion():
    big, small = [np.array([(0, 0), (100, 0), (100, 70), (0, 70)], float)], [np.array([(0, 0), (32, 0), (32, 32), (0, 32)], float)]
    out, done, exact = G.erode(big)
    assert done and exact and G.area(out) == pytest.approx(80 * 50)
    assert G.erode(small)[1] is False
    strip = [np.array([(0, 0), (400, 0), (400, 15), (0, 15)], float)]
    assert G.erode(strip)[1] is False
    assert G.erode([np.array(SHAPES[2], float)])[1:] == (True, False)


def test_context_buffer():
    r = [np.array([(0, 0), (100, 0), (100, 100), (0, 100)], float)]
    b = G.context_buffer(r, 40_000)
    assert 10_000 + 400 * b + math.pi * b * b == pytest.approx(40_000, rel=1e-4) and G.context_buffer(r, 5_000) == 0.0


def test_unmix(spark):
    crop, soil = [0.05, 0.08, 0.05, 0.5], [0.15, 0.2, 0.25, 0.3]
    s = [0.75 * a + 0.25 * b for a, b in zip(crop, soil, strict=True)]
    df = frame(spark, [(1, s), (2, [1.0]), (3, None)], "id long, s array<double>")
    got = {r.id: r for r in G.unmix(df, "s", {"crop": crop, "soil": soil}).collect()}
    assert got[1].crop == pytest.approx(0.75, abs=1e-6) and got[1].crop + got[1].soil == pytest.approx(1) and got[1].rmse < 0.05
    assert got[2].crop is None and got[3].rmse is None


def test_parcel_cells_and_ring(spark):
    p = frame(spark, [("a", square(400110, 1899690, 400150, 1899720)), ("bad", "{}")], "land string, g string")
    c = G.cover_cells(p, "land", "g")
    assert c.agg(F.sum("coverage")).first()[0] == pytest.approx(12.0) and c.select("land").distinct().count() == 1
    ring = G.ring_cells(p, "land", "g")
    assert ring.where("distance < 10 or distance > 150").count() == 0
    w = G.ring_width(ring, "land", "distance").first()
    assert w.ring_m == 20.0


def test_variogram():
    i, j = np.indices((12, 12))
    v = (i // 6 + j // 6) * 0.1
    n, se, span, sill, nugget, method = variogram.kernel(i.ravel().astype(float), j.ravel().astype(float), v.ravel(), np.ones(144))
    assert method == "empirical_variogram" and 1 <= n < 144 and span >= 1 and se > 0 and nugget <= sill
    assert variogram.kernel(*(np.zeros(3),) * 3, np.ones(3))[-1] == "insufficient_variogram_support_kish"


@pytest.mark.parametrize("n", [5, 60, 200])
def test_variogram_by_blocks(n):
    rng = np.random.default_rng(n)
    r, c, v, w = rng.integers(0, 20, n).astype(float), rng.integers(0, 20, n).astype(float), rng.random(n), rng.random(n)
    i, j = np.triu_indices(n, 1)
    d, g = np.hypot(r[i] - r[j], c[i] - c[j]), 0.5 * (v[i] - v[j]) ** 2
    whole, parts = variogram.kernel(r, c, v, w), variogram.kernel(r, c, v, w, most=53)
    assert whole == parts and whole[3] == pytest.approx(np.percentile(g, 90), rel=1e-12)
    assert whole[4] == pytest.approx(np.percentile(g[d <= np.percentile(d, 25)], 10), rel=1e-12)


def test_nnls_meets_its_conditions():
    rng = np.random.default_rng(3)
    a, b = rng.random((12, 5)), rng.normal(0.2, 0.6, (200, 12))
    x = G.nnls(a, b)
    slope = (b - x @ a.T) @ a
    assert (x >= 0).all() and (slope <= 1e-8).all() and np.abs(slope * x).max() < 1e-8
    assert (x == 0).any() and (x > 0).any()
    with pytest.raises(ValueError):
        G.nnls(np.ones((3, 11)), np.ones((1, 3)))


def test_robust_location_with_ties_and_empty_weights(spark):
    rows = [("a", 0.2, 1.0), ("a", 0.2, 3.0), ("a", 0.8, 4.0), ("b", 0.5, 2.0), ("b", None, 5.0), ("c", 0.1, 0.0)]
    got = {r.k: (r.n_cells, r.effective_cells, r.median, r.mad, r.p10, r.p90) for r in stats.context_summary(frame(spark, rows, "k string, v double, w double"), ["k"], "v", "w").collect()}
    assert got == {"a": (3, 8.0, 0.2, 0.0, 0.2, 0.8), "b": (1, 2.0, 0.5, 0.0, 0.5, 0.5)}


def test_raster(spark):
    a = np.arange(16, dtype="<f4").reshape(4, 4)
    a[0, 0] = np.nan
    tiles = frame(spark, [("s", "b04", 8, 4, 4, 4, bytearray(a.tobytes()))], raster.TILE)
    assert raster.cells_of(tiles).count() == 15
    assert raster.window(tiles, 8, 4, 10, 6).count() == 3 and raster.window(tiles, 0, 0, 8, 4).count() == 0
    fine = raster.regrid_nearest(raster.cells_of(tiles))
    assert fine.count() == 60 and {r.value for r in fine.where("row = 19 and col in (10, 11)").collect()} == {5.0}
    lin = raster.regrid_bilinear(frame(spark, [(r, c, float(c)) for r in range(4) for c in range(4)], "row long, col long, value double").selectExpr("1 as k", "row", "col", "value"), ["k"])
    got = {(r.row, r.col): r.value for r in lin.collect()}
    assert len(got) == 64 and got[3, 3] == pytest.approx(1.25) and got[3, 0] == pytest.approx(0.0)
    img = raster.render(raster.cells_of(tiles), ["scene_id"]).first()
    assert bytes(img.png[:8]) == b"\x89PNG\r\n\x1a\n" and (img.width, img.height) == (4, 4)
    sub = raster.block_subset(raster.cells_of(tiles), frame(spark, [("L", 8, 4, 10, 6), ("M", 9, 5, 12, 8)], "land_id string, r0 long, c0 long, r1 long, c1 long"), 3)
    assert {(r.land_id, r["count"]) for r in sub.groupBy("land_id").count().collect()} == {("L", 3), ("M", 9)}


def pairs(spark, lands=12):
    rows = [(f"L{k}", 0.40 + 0.001 * j, 0.50, 0.52) for k in range(lands) for j in range(3)]
    return frame(spark, rows, "land_id string, native_ndvi double, estimated_ndvi double, reference_ndvi double")


def test_validation(spark, tmp_path):
    b = V.bootstrap(pairs(spark), "land_id", "native_ndvi", "estimated_ndvi", "reference_ndvi", resamples=200)
    assert b["status"] == "evaluated" and b["supported"] and b["ci95_lower"] <= b["mae_improvement_native_minus_estimated"] <= b["ci95_upper"]
    assert V.bootstrap(pairs(spark, 3), "land_id", "native_ndvi", "estimated_ndvi", "reference_ndvi")["supported"] is False
    many = frame(spark, [(f"L{k}", k / 400, k / 1000, 0.0) for k in range(400)], "land_id string, native_ndvi double, estimated_ndvi double, reference_ndvi double")
    one, more = (V.bootstrap(many, "land_id", "native_ndvi", "estimated_ndvi", "reference_ndvi", resamples=1500, block=n) for n in (1000, 37))
    pick = np.random.default_rng(0).integers(0, 400, (4000, 400)).mean(axis=1) * (1 / 400 - 1 / 1000)
    for got in (one, more):
        assert (got["ci95_lower"], got["ci95_upper"]) == pytest.approx(np.percentile(pick, [2.5, 97.5]), rel=0.02)
    assert more == V.bootstrap(many, "land_id", "native_ndvi", "estimated_ndvi", "reference_ndvi", resamples=1500, block=37)
    train, test = V.grouped_split(pairs(spark), "land_id")
    assert V.leakage(train, test, "land_id").count() == 0 and test.select("land_id").distinct().count() == 2
    with pytest.raises(ValueError):
        V.check_reference("sentinel-2")
    f = tmp_path / "v.csv"
    f.write_text("land_id,date,native_ndvi,estimated_ndvi,reference_ndvi\nL1,2026-01-01,0.4,x,nan\n")
    r = V.load_pairs(spark, str(f)).first()
    assert (r.native_ndvi, r.estimated_ndvi, r.reference_ndvi) == (0.4, None, None)


def test_schema_alignment(spark):
    df = spark.range(1).selectExpr("id", "1 as extra")
    out, gone = rules.align_to_schema(df, ["id", "other"])
    assert out.columns == ["id"] and gone == ["extra"] and rules.align_to_schema(df, [])[1] == []


def test_path_tenant(spark):
    t = "123e4567-e89b-12d3-a456-426614174000"
    got = frame(spark, [(f"{t}/x/y.png",), ("me/x.png",)], "p string").select(rules.path_tenant(F.col("p")).alias("t")).collect()
    assert [r.t for r in got] == [t, None]


def test_pipeline_measures(spark):
    rng = np.random.default_rng(7)
    rows = [("L1", s, r, c, 1.0, 9 if s == "B" and r < 5 else 4, 0.05, 0.08, 0.1 + rng.normal(0, 0.005), 0.5, 0.2) for s in "AB" for r in range(8) for c in range(8)]
    cells = frame(spark, rows, "land_id string, scene_id string, row int, col int, coverage double, scl int, b02 double, b03 double, b04 double, b08 double, b11 double")
    lands = frame(spark, [("L1", "T", 1.6, "high", True)], "land_id string, tenant_id string, acres double, geometry_confidence string, buffered boolean")
    out = pipeline.measure_optical(cells, lands)
    good, bad = pipeline.split_outcomes(out)
    a, b = good.first(), bad.first()
    assert a.scene_id == "A" and a.ndvi_value == pytest.approx(0.667, abs=5e-3) and a.measurement_status == "OBSERVED_STRONG" and a.effective_pixel_count == 64
    assert b.scene_id == "B" and b.reject_reason.startswith("field cloud 62%") and "ndre_value" not in out.columns
    ring = frame(spark, [("L1", "A", 0.6, 0.01, 25, "real")], "land_id string, scene_id string, median double, mad double, n_cells int, tier string")
    rec = pipeline.promote(pipeline.enrich_context(good, ring).withColumn("acquisition_date", F.lit("2026-09-01").cast("date"))).first()
    assert rec.observed_or_predicted == "observed" and rec.parcel_context_delta == pytest.approx(a.ndvi_value - 0.6) and rec.estimated_ndvi is None


def test_mask_fractions_leave_no_data_out(spark):
    """Class 0 and cells without a class are not of the field; class 2 is shadow and dark; class 7 is unaccounted."""
    rows = [(1, 4, 1.0), (1, 4, 0.5), (1, 0, 1.0), (1, None, 1.0), (1, 7, 0.5), (1, 2, 1.0), (1, 9, 0.0), (2, 0, 1.0)]
    got = {r.f: r for r in stats.mask_fractions(spark.createDataFrame(rows, "f int, scl int, w double"), ["f"], "scl", "w").collect()}
    one = got[1]
    assert (one.n_field_pixels, one.n_crop_pixels, one.epc_total, one.epc_crop) == (4, 2, 3.0, 1.5)
    assert (one.crop_fraction, one.unaccounted_fraction, one.cloud_fraction) == (0.5, 0.5 / 3, 0.0)
    assert one.shadow_fraction == one.dark_fraction == 1 / 3
    assert (got[2].n_field_pixels, got[2].epc_total, got[2].crop_fraction) == (0, 0.0, 0.0)


def test_dilation_grows_onto_unclassified(spark):
    """Cloud and cloud shadow reach class 7, not class 0; in two steps past a cell of no data too."""
    rows = [(0, c, k) for c, k in enumerate((9, 7, 4, 4, 0, 3, 0, 4, 10))] + [(1, c, 4) for c in range(9)]
    cells = spark.createDataFrame([(1, *r) for r in rows], "f int, r int, c int, scl int")
    for rounds in (1, 2):
        code = {(r, c): k for r, c, k in rows}
        at = lambda wanted: {(r + a, c + b) for (r, c), k in code.items() if k in wanted for a in range(-2, 3) for b in range(-2, 3) if abs(a) + abs(b) <= rounds}  # noqa: B023, E731
        want = {p: 9 if k not in (0, 8, 9, 10) and p in at((8, 9, 10)) else 3 if k not in (0, 8, 9, 10) and p in at((3,)) else k for p, k in code.items()}
        assert {(r.r, r.c): r.scl for r in stats.dilate(cells, ["f"], "r", "c", "scl", rounds).collect()} == want


def test_binary_target_touches_corners():
    square = [np.array([[0.0, 0.0], [10.5, 0.0], [10.5, 10.5], [0.0, 10.5]])]
    got = G.binary_target(square, 0.0, 20.0, 10.0, 2, 2)
    assert got.tolist() == [[1, 1], [1, 1]]
    assert G.binary_target([square[0] * (10 / 10.5)], 0.0, 20.0, 10.0, 2, 2).tolist() == [[0, 0], [1, 0]]
    rng = np.random.default_rng(3)
    for _ in range(30):
        ring = rng.uniform(3, 57, (3, 2))
        cover = np.array([[abs(G.ring_area(p)) if len(p := G.clip(ring, 10.0 * c, 50.0 - 10 * r, 10.0 * c + 10, 60.0 - 10 * r)) >= 3 else 0 for c in range(6)] for r in range(6)])
        assert ((cover > 1e-9) <= (G.binary_target([ring], 0.0, 60.0, 10.0, 6, 6) > 0)).all()
