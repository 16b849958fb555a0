"""Sides and thresholds that sums fall right upon: the answer is that of exact sums, whatever the order of the rows."""

import random

import duckdb
import oracle
import pytest

from zonalith.plans import catalog


def written(spark, folder, rows):
    names = "l_suppkey long, l_orderkey long, l_linenumber int, l_discount double, l_extendedprice double, l_quantity double"
    df = spark.createDataFrame(rows, names).selectExpr("*", "l_orderkey l_partkey", "0.04D l_tax", "'A' l_returnflag")
    df.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def centred(spark, tmp_path_factory):
    """Fields whose centre is on column 2 and row 12: weights alike on either side, in any order; the centre column is poor."""
    rng, rows = random.Random(7), []
    for field in range(300):
        own = [(c, r, 10) for c in (1, 2, 3) for r in (10, 11, 13, 14)]
        for _ in range(40):
            k, r = rng.randrange(1, 10), rng.randrange(1, 8)
            own += [(c, r + d, k) for c in (1, 3) for d in (0, 24 - 2 * r)] + [(2, 12, k)]
        rng.shuffle(own)
        rows += [(field, r, c, k / 100, 20000.0 if c == 2 else 60000.0, 20.0) for c, r, k in own]
    return written(spark, tmp_path_factory.mktemp("centred"), rows)


def test_zone_levels_at_the_centre(spark, centred):
    got = catalog.QUERIES["zone_levels"](spark, centred).collect()
    assert len(got) == 300 and {r.weakest[1] for r in got} == {"E"}


def test_zone_quarters_at_the_centre(spark, centred):
    """The centre column is east, and its cells of the centre row south-east."""
    got = {}
    for r in catalog.QUERIES["zone_quarters"](spark, centred).collect():
        got.setdefault(r.field, {})[r.quarter] = r.epc
    assert len(got) == 300
    assert all(q["NE"] > q["NW"] and q["SE"] > q["SW"] and q["SW"] == pytest.approx(q["NW"]) for q in got.values())


def test_zone_quarters_without_weight(spark, tmp_path):
    rows = [(1, r, c, 0.0, 60000.0, 20.0) for r in (1, 2) for c in (1, 2)]
    got = catalog.QUERIES["zone_quarters"](spark, written(spark, tmp_path, rows)).collect()
    assert [(r.field, r.quarter, r.interior_cells, r.epc, r.ndvi) for r in got] == [(1, "NW", 0, 0.0, None)]


def against_sql(spark, folder, rows, name="zone_quarters"):
    path, db = written(spark, folder, rows), duckdb.connect()
    db.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{path}/lineitem.parquet/*.parquet')")
    return oracle.difference(spark, db, name, catalog.QUERIES[name], catalog.ORACLE[name], path)


@pytest.mark.parametrize(
    "discount, stretch",
    [
        (lambda r, c: -0.01 * (1 + r * c % 9), 1),
        (lambda r, c: 0.05 if r == 1 else -0.03, 1),
        (lambda r, c: (2 - c) * 0.1, 1),
        (lambda r, c: -1e6 if r == 1 else 0.03 + c / 100, 1),
        (lambda r, c: float("-inf") if r == 1 else 0.03, 1),
        (lambda r, c: 0.03 + c / 100, 700000000),
    ],
    ids=["negative", "negative in sum", "none in sum", "beyond the decimals", "infinite", "far columns"],
)
def test_zone_quarters_odd_weights(spark, tmp_path, discount, stretch):
    rows = [(1, r, c * stretch, discount(r, c), 60000.0 + r, 20.0) for r in (1, 2, 3, 4) for c in (1, 2, 3)]
    assert against_sql(spark, tmp_path, rows) is None


def test_zone_quarters_at_half_of_the_last_place(spark, tmp_path):
    """One value in each field, so that no sum is open: the mean is rounded as in the SQL."""
    rows = [(i, 1, 1, 0.1, 60000.0, (2 * i + 1) / 20000) for i in range(100000, 400000, 199) for _ in range(2)]
    assert against_sql(spark, tmp_path, rows) is None


def test_histogram_stats_at_the_shares(spark, tmp_path):
    """Bins of exactly a tenth, four tenths, four tenths and a tenth of the weight: the shares are reached at the first, second and third."""
    rng, rows = random.Random(3), []
    for field in range(300):
        ks = [rng.randrange(1, 10) for _ in range(30)]
        own = [(k, v) for k in ks for v, n in ((0.15, 1), (0.35, 4), (0.55, 4), (0.75, 1)) for _ in range(n)]
        rng.shuffle(own)
        rows += [(field, i, 1, k / 100, 100000.0 * 0.2 * (1 + v) / (1 - v), 20.0) for i, (k, v) in enumerate(own)]
    got = catalog.QUERIES["histogram_stats"](spark, written(spark, tmp_path, rows)).collect()
    assert len(got) == 300 and {(r.p10, r.p50, r.p90) for r in got} == {(0.15, 0.35, 0.55)}
