"""Operators behind the queries over whole tables, on small fixtures."""

import inspect
import random

import oracle
import pytest
from pyspark.sql import functions as F

from zonalith.operators import geometry as G, incremental as I, temporal as T, validation as V
from zonalith.plans import bindings as B, catalog, pipeline

def series(spark, rows):
    return spark.createDataFrame([(i, land, d, v, 0.9 if q is None else q) for i, (land, d, v, q) in enumerate(rows)], "id long, land long, d string, v double, q double").withColumn("d", F.to_date("d"))


def test_trend_of_sparse_series(spark):
    """Fewer than three points; the last three where the window holds fewer; the window; points of one day."""
    rows = [(1, "2024-01-01", 0.5, None), (1, "2024-01-05", 0.6, None), (1, "2024-01-06", None, None)]
    rows += [(2, d, v, None) for d, v in (("2023-10-03", 0.9), ("2023-11-02", 0.2), ("2023-12-02", 0.3), ("2024-01-01", 0.5))]
    rows += [(3, d, v, None) for d, v in (("2023-10-03", 0.9), ("2023-12-31", 0.4), ("2024-01-05", 0.5), ("2024-01-10", 0.6))]
    rows += [(4, "2024-01-01", v, None) for v in (0.1, 0.2, 0.3)]
    got = {r.land: r for r in T.trend(series(spark, rows), "land", "d", "v", "id", digits=9).collect()}
    assert [(got[k].n_points, got[k].span_days, got[k].direction) for k in (1, 2, 3, 4)] == [(2, None, "insufficient_data"), (3, 60.0, "improving"), (3, 10.0, "sharp_improving"), (3, 0.0, "insufficient_data")]
    assert [(got[k].slope_per_day, got[k].delta_total) for k in (1, 2, 3, 4)] == [(None, None), (0.005, 0.3), (0.02, 0.2), (None, None)]


def test_forecast_of_sparse_series(spark):
    """Two points, a last gap over twelve days, and too few points of sufficient quality give nothing."""
    ok = (("2024-01-01", 0.30), ("2024-01-06", 0.36), ("2024-01-11", 0.42), ("2024-01-16", 0.47))
    rows = [(1, d, v, None) for d, v in ok[:2]] + [(2, d, v, None) for d, v in (*ok[:3], ("2024-01-25", 0.5))]
    rows += [(3, d, v, None) for d, v in ok] + [(4, d, v, 0.5 if k else 0.9) for k, (d, v) in enumerate(ok)]
    rows += [(5, d, v, None) for d, v in (*ok[:3], ("2024-01-23", 0.5))]
    got = T.forecast(series(spark, rows), "land", "d", "v", "q", "id").collect()
    assert sorted((r.land, str(r.date)) for r in got) == [(3, f"2024-01-{d}") for d in range(17, 22)] + [(5, f"2024-01-{d}") for d in range(24, 29)]
    assert {r.training_count for r in got} == {4}


def test_repair_of_lands_without_rows(spark):
    """The newest row that has a value, whatever its id; lands without one are kept with NULL."""
    rows = series(spark, [(1, "2024-01-01", 0.1, None), (1, "2024-01-03", 0.3, None), (1, "2024-01-03", 0.2, None), (1, "2024-01-04", None, None), (3, "2024-01-01", None, None), (9, "2024-01-01", 0.9, None)])
    own = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    got = I.repair_from_newest(own, rows.withColumnRenamed("id", "event"), "id", "land", ["d", "event"], "v").collect()
    assert sorted((r.id, r.new_value) for r in got) == [(1, 0.2), (2, None), (3, None)]


def test_box_join_meets_every_pair(spark):
    """Against brute force: boxes over several tiles, touching edges, negative places, unknown boxes."""
    rng = random.Random(4)
    box = lambda most: (x := rng.randrange(-60, 60), y := rng.randrange(-60, 60), x + rng.randrange(most), y + rng.randrange(most))
    left = [(k, k % 2, *map(float, box(15))) for k in range(40)]
    right = [(k, k % 2, *([None] * 4 if k % 9 == 0 else map(float, box(45)))) for k in range(60)]
    schema = "{} long, g long, x0 double, y0 double, x1 double, y1 double"
    got = G.box_join(spark.createDataFrame(left, schema.format("land")), spark.createDataFrame(right, schema.format("scene")), ["g"], 20.0).select("land", "scene").collect()
    meet = lambda a, b: b[2] is None or (a[2] <= b[4] and b[2] <= a[4] and a[3] <= b[5] and b[3] <= a[5])
    assert sorted(map(tuple, got)) == sorted((a[0], b[0]) for a in left for b in right if a[1] == b[1] and meet(a, b))


def test_bootstrap_interval_is_registered_with_the_defaults(spark, monkeypatch):
    """2000 resamples and ten lands at least: no argument cuts the operator's own defaults."""
    seen, real = [], V.bootstrap
    monkeypatch.setattr(V, "bootstrap", lambda *a, **kw: seen.append(inspect.signature(real).bind(*a, **kw)) or {})
    catalog.QUERIES["bootstrap_interval"](spark, "/root/testdata/sf0.001")
    seen[0].apply_defaults()
    assert (seen[0].arguments["resamples"], seen[0].arguments["min_lands"]) == (2000, 10)


def test_observe_splits_adds_context_and_promotes(spark):
    rows = [("L1", s, 1.0, code if k < 40 else 4, 0.05, 0.08, 0.1, 0.5, 0.2) for s, code in (("clear", 4), ("cloud", 9), ("snow", 11)) for k in range(64)]
    cells = spark.createDataFrame(rows, "land_id string, scene_id string, coverage double, scl int, b02 double, b03 double, b04 double, b08 double, b11 double")
    lands = spark.createDataFrame([("L1", "T", 1.6, "high", True)], "land_id string, tenant_id string, acres double, geometry_confidence string, buffered boolean")
    ring = spark.createDataFrame([("L1", "clear", 0.6, 0.01, 25, "real")], "land_id string, scene_id string, median double, mad double, n_cells int, tier string")
    scenes = spark.createDataFrame([("clear", "2026-09-01")], "scene_id string, day string").select("scene_id", F.to_date("day").alias("acquisition_date"))
    got = {r.scene_id: r for r in pipeline.observe(cells, lands, ring, scenes).collect()}
    assert {k: r.outcome for k, r in got.items()} == {"clear": "accepted", "cloud": "rejected", "snow": "rejected"}
    ok = got["clear"]
    assert ok.observed_ndvi == ok.ndvi_value and ok.parcel_context_delta == pytest.approx(ok.ndvi_value - 0.6) and ok.context_present
    assert "cloud" in got["cloud"].reject_reason and got["snow"].reject_reason and got["cloud"].observed_ndvi is None


def test_measured_and_radar_queries(spark, sf_dir):
    """Every land and scene has its outcome by its real classes; radar measures the newest pass of each land only."""
    out = catalog.QUERIES["measured_observations"](spark, sf_dir).collect()
    keys = {(r.field, r.scene) for r in B.cells(spark, sf_dir).select("field", "scene").distinct().collect()}
    assert len(out) == len(keys) and {(r.land_id, r.scene_id) for r in out} == keys
    assert all((r.outcome == "rejected") == (r.reject_reason is not None) == (r.observed_ndvi is None) for r in out)
    radar = catalog.QUERIES["radar_observations"](spark, sf_dir).collect()
    assert sorted(r.land_id for r in radar) == sorted({k for k, _ in keys})


def test_box_join_of_large_groups(spark, monkeypatch):
    """Rows without a box against a group of several blocks, repeated rows and a group without any: all pairs, and no group is one task."""
    monkeypatch.setattr(G, "BLOCK", 7)
    left = spark.range(60).selectExpr("id % 50 land", "id % 3 g", "0D x0", "0D y0", "1D x1", "1D y1")
    right = spark.range(200).selectExpr("id % 190 scene", "id % 4 g", "CAST(NULL AS DOUBLE) x0", "0D y0", "CAST(NULL AS DOUBLE) x1", "1D y1")
    out = G.box_join(left, right, ["g"], 20.0).select("land", "scene", F.spark_partition_id().alias("task"))
    got = out.collect()
    want = sorted((a % 50, b % 190) for a in range(60) for b in range(200) if a % 3 == b % 4)
    assert sorted((r.land, r.scene) for r in got) == want
    assert len({r.task for r in got}) > 20
