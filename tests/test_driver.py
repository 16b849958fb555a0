"""The nightly run: a second night, redrawn boundaries, radar modes, jobs and exit codes."""

import argparse
import datetime as dt

from pyspark.sql import functions as F

from zonalith import jobs, schemas
from zonalith.operators import incremental as I
from zonalith.plans import land_driver as D
from zonalith.sources import scenes as S

DAY = dt.date(2024, 5, 1)


def tables(spark):
    """Land 1 clear, 2 cloudy with a radar pass, 3 without a boundary, 4 with a scene that could not be read."""
    lands = spark.createDataFrame([(k, "t", 3.0, "high", True, None if k == 3 else f"g{k}") for k in (1, 2, 3, 4)], "land_id long, tenant_id string, acres double, geometry_confidence string, buffered boolean, geometry_fingerprint string")
    scenes = spark.createDataFrame([(k, "s1", DAY, "10:00", 5.0, True, 1.0) for k in (1, 2, 3, 4)] + [(1, "s0", DAY, "10:00", 5.0, False, 0.4), (1, "full", DAY, "11:00", 99.0, True, 1.0), (1, "old", DAY - dt.timedelta(60), "09:00", 1.0, True, 1.0)], "land_id long, scene_id string, acquisition_date date, acquired_at string, cloud double, contains boolean, overlap double")
    cells = [(k, s, r, c, 1.0, 4 if k == 1 else 9, 0.5, 0.1 + 0.001 * c, 0.1, 0.2, 0.1) for k in (1, 2) for s in ("s1", "s0", "full", "old") for r in range(6) for c in range(6)]
    cells = spark.createDataFrame(cells, "land_id long, scene_id string, row int, col int, coverage double, scl int, b08 double, b04 double, b03 double, b11 double, b02 double")
    passes = spark.createDataFrame([(2, "r1", DAY - dt.timedelta(3)), (2, "r0", DAY - dt.timedelta(9)), (1, "r1", DAY)], "land_id long, scene_id string, acquisition_date date")
    radar = spark.createDataFrame([(k, s, 0.2, 0.05, 1.0) for k in (1, 2) for s in ("r0", "r1") for _ in range(30)], "land_id long, scene_id string, vv double, vh double, coverage double")
    history = spark.createDataFrame([(1, DAY - dt.timedelta(2), 0.01)], "land_id long, acquisition_date date, ndvi_value double")
    return lands, scenes, cells, passes, radar, history


def night(spark, ledger=None, lands=None, **how):
    own, scenes, cells, passes, radar, history = tables(spark)
    ledger = spark.createDataFrame(ledger or [], schemas.LEDGER)
    return D.night(own if lands is None else lands, scenes, cells, passes, radar, ledger, history, "v", F.lit(DAY), **how)


def report(n):
    return {r.land_id: r for r in n.lands.collect()}


def test_first_and_second_night(spark):
    first = night(spark)
    got = report(first)
    assert [got[k].status for k in (1, 2, 3, 4)] == ["completed", "completed", "failed", "no_data"]
    assert (got[1].items, got[1].deduped, got[1].pending, got[1].accepted, got[1].radar) == (2, 1, 1, 1, 0)
    assert (got[2].accepted, got[2].rejected, got[2].radar, got[2].snapshot) == (0, 1, 1, False) and got[4].retry == 1
    rows = first.accepted.collect()
    assert [(r.land_id, r.scene_id, r.temporal_outlier) for r in rows] == [(1, "s1", True)]
    ledger = [tuple(r) for r in first.ledger.collect()]
    assert {(r[0], r[1], r[5]) for r in ledger} == {(1, "s1", "accepted"), (2, "s1", "rejected"), (2, "r1", "accepted")}
    again = report(night(spark, ledger))
    assert [again[k].status for k in (1, 2, 3, 4)] == ["unchanged", "no_data", "failed", "no_data"]
    assert (again[1].pending, again[1].known, again[2].radar) == (0, 1, 0)
    assert report(night(spark, ledger, reprocess=True))[1].accepted == 1
    moved = tables(spark)[0].withColumn("geometry_fingerprint", F.concat("geometry_fingerprint", F.lit("x")))
    assert report(night(spark, ledger, moved))[1].accepted == 1


def test_radar_modes(spark):
    assert report(night(spark, radar_mode="always"))[1].radar == 1
    assert sum(r.radar for r in report(night(spark, radar_mode="off")).values()) == 0


def test_night_job_and_promotion(spark, tmp_path):
    for name, t in zip(("lands", "scenes", "cells", "radar_passes", "radar_cells", "history"), tables(spark), strict=True):
        t.write.parquet(f"{tmp_path}/in/{name}")
    a = argparse.Namespace(tables=f"{tmp_path}/in", out=f"{tmp_path}/out", tenant=None, as_of=str(DAY), lookback=20, backfill=False, reprocess=False, dry_run=False, radar="fallback", version="v")
    assert jobs.night(spark, a) == 0
    p = argparse.Namespace(observations=f"{tmp_path}/out/accepted", out=f"{tmp_path}/promoted", tenant=None, since=None)
    assert jobs.promote(spark, p) == 0 and spark.read.parquet(p.out).first().observed_ndvi is not None
    p.since = "2030-01-01"
    assert jobs.promote(spark, p) == 0
    a.as_of = "2030-01-01"
    assert jobs.night(spark, a) == 2
    assert [I.exit_code(*x) for x in ((0, 0, 0), (0, 3, 0), (5, 0, 1), (5, 0, 0))] == [2, 0, 3, 0]


def test_scenes_by_box(spark):
    rows = spark.createDataFrame([(1, (0.0, 0.0, 2.0, 2.0)), (2, (5.0, 5.0, 6.0, 6.0)), (3, None)], "id int, box struct<x0:double,y0:double,x1:double,y1:double>")
    assert [r.id for r in rows.where(S.meets("box", F.lit(1.0), F.lit(1.0), F.lit(3.0), F.lit(3.0))).orderBy("id").collect()] == [1, 3]
