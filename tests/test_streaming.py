"""Streams run to their end on small files."""

import datetime as dt

from pyspark.sql import functions as F

from zonalith.streaming import observations as O

SCHEMA = "land string, scene string, t timestamp, v double"


def day(n):
    return dt.datetime(2026, 9, n, 10)


def files(spark, path, batches):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/in/b={k}")
    return O.bounded_source(spark, f"{path}/in", f"{SCHEMA}, b int", 1).drop("b")


def finish(query):
    query.processAllAvailable()
    query.stop()


def test_upsert_stream_is_exactly_once(spark, tmp_path):
    stream = files(spark, tmp_path, [[("L1", "A", day(1), 0.1), ("L2", "A", day(1), 0.2)], [("L1", "A", day(1), 0.15), ("L1", "B", day(3), 0.3)]])
    sink, out = O.upsert_sink(f"{tmp_path}/table", ["land", "scene"], ["t", "v"]), f"{tmp_path}/table"
    finish(stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/cp").start())
    want = {("L1", "A", 0.15), ("L2", "A", 0.2), ("L1", "B", 0.3)}
    assert {(r.land, r.scene, r.v) for r in O.current(spark, out).collect()} == want
    sink(spark.createDataFrame([("L1", "A", day(1), 0.15), ("L1", "B", day(3), 0.3)], SCHEMA), 1)
    assert {(r.land, r.scene, r.v) for r in O.current(spark, out).collect()} == want


def test_sinks_touch_their_buckets_only(spark, tmp_path):
    out = f"{tmp_path}/table"
    sink = O.upsert_sink(out, ["land", "scene"], ["t", "v"], buckets=4)
    rows = lambda lands, n: spark.createDataFrame([(f"L{k}", "A", day(n), n / 10) for k in lands], SCHEMA)
    state = lambda **kw: {(r.land, r.v) for r in O.current(spark, out, **kw).collect()}
    sink(rows([], 1), 0)
    assert O.current(spark, out) is None
    sink(rows(range(40), 1), 1)
    assert sorted(O.versions(spark, out)) == [0, 1, 2, 3]
    for n in (2, 3, 4):
        sink(rows([7], n), n)
    found = O.versions(spark, out)
    assert sorted(found.values()) == [[1], [1], [1], [4, 3]]
    want = {(f"L{k}", 0.4 if k == 7 else 0.1) for k in range(40)}
    assert state() == want and state(below=4) == {(a, 0.3 if a == "L7" else v) for a, v in want}
    sink(rows([7], 4), 4)
    assert state() == want and O.versions(spark, out) == found


def test_snapshot_stream_moves_forward(spark, tmp_path):
    stream = files(spark, tmp_path, [[("L1", "B", day(5), 0.5)], [("L1", "A", day(1), 0.9), ("L2", "A", day(1), 0.2)]])
    sink = O.snapshot_sink(f"{tmp_path}/snap", "land", "t")
    finish(stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/cp").start())
    assert {(r.land, r.v) for r in O.current(spark, f"{tmp_path}/snap").collect()} == {("L1", 0.5), ("L2", 0.2)}


def test_first_sight_and_daily(spark, tmp_path):
    rows = [[("L1", "A", day(1), 0.1)], [("L1", "A", day(1), 0.1), ("L1", "C", day(2), 0.3)]]
    stream = files(spark, tmp_path, rows)
    q = O.first_sight(stream, "t", ["land", "scene"]).writeStream.format("memory").queryName("seen").option("checkpointLocation", f"{tmp_path}/cp").start()
    finish(q)
    assert spark.sql("select scene from seen").count() == 2
    q = O.daily(stream, "t", "land", "v").writeStream.outputMode("update").format("memory").queryName("days").option("checkpointLocation", f"{tmp_path}/cp2").start()
    finish(q)
    assert spark.sql("select max(n) from days").first()[0] == 2


def test_persistent_zones(spark, tmp_path):
    schema = "land string, t timestamp, w string, level string"
    for k, rows in enumerate([[("L1", day(1), "SE", "watch"), ("L2", day(1), "NE", "none")], [("L1", day(4), "SE", "watch"), ("L2", day(4), "NE", "watch")], [("L1", day(7), "NW", "watch"), ("L1", day(2), "SE", "watch")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/b={k}")
    stream = O.bounded_source(spark, f"{tmp_path}/in", f"{schema}, b int", 1).drop("b")
    finish(O.persistent_zones(stream, "land", "t", "w", "level").writeStream.outputMode("append").format("memory").queryName("zones").option("checkpointLocation", f"{tmp_path}/cp").start())
    got = {(r.k, r.t.day, r.level) for r in spark.sql("select * from zones").collect()}
    assert got == {("L1", 1, "watch"), ("L2", 1, "none"), ("L1", 4, "check"), ("L2", 4, "watch"), ("L1", 7, "watch"), ("L1", 2, "watch")}


def test_outliers_in_a_batch(spark):
    hist = spark.createDataFrame([("L", dt.date(2026, 9, 1), 0.8)], "land string, d date, v double")
    batch = spark.createDataFrame([("L", dt.date(2026, 9, 4), 0.3), ("L", dt.date(2026, 9, 20), 0.3)], "land string, d date, v double")
    got = {str(r.d): r.temporal_outlier for r in O.flag_outliers(batch, hist, "land", "d", "v").collect()}
    assert got == {"2026-09-04": True, "2026-09-20": False}
    assert batch.where(F.col("v") > 1).count() == 0
