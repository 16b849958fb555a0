"""Geometry of parcels on grids: NumPy kernels inside Arrow functions, and the joins around them.

A polygon is a list of rings of (x, y), the first the outer one, holes after it. Kernels see one parcel at a time with the
cells of its bounding box; nothing here depends on the number of parcels.
"""

from __future__ import annotations

import itertools
import json
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from zonalith import constants as C
from zonalith.session import reach_workers

RINGS = "array<array<struct<x:double,y:double>>>"


def rings_of(geojson: str | None) -> list[np.ndarray] | None:
    """Rings of a GeoJSON Polygon or of the largest part of a MultiPolygon; None when unusable."""
    try:
        g = json.loads(geojson) if geojson else None
        parts = {"Polygon": lambda c: [c], "MultiPolygon": lambda c: c}[g["type"]](g["coordinates"])
        made = [[np.asarray(r, float)[:, :2] for r in p] for p in parts]
        made = [p for p in made if p and len(p[0]) >= 3 and np.isfinite(p[0]).all() and abs(area(p)) > 0]
        return max(made, key=lambda p: abs(area(p))) if made else None
    except (ValueError, KeyError, TypeError, IndexError):
        return None


def ring_area(r: np.ndarray) -> float:
    x, y = r[:, 0], r[:, 1]
    return 0.5 * float(np.dot(x, np.roll(y, -1)) - np.dot(np.roll(x, -1), y))


def area(rings: list[np.ndarray]) -> float:
    return abs(ring_area(rings[0])) - sum(abs(ring_area(h)) for h in rings[1:])


def clip(ring: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """The ring within a rectangle. The rectangle is the convex side, so the ring may have any shape."""
    pts = ring
    for axis, bound, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        if not len(pts):
            break
        d = sign * (pts[:, axis] - bound)
        nxt, dn = np.roll(pts, -1, axis=0), np.roll(d, -1)
        out = []
        for p, q, a, b in zip(pts, nxt, d, dn, strict=True):
            if a >= 0:
                out.append(p)
            if (a >= 0) != (b >= 0):
                out.append(p + (q - p) * (a / (a - b)))
        pts = np.array(out) if out else np.zeros((0, 2))
    return pts


def inside(rings: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Even-odd test of points."""
    hit = np.zeros(len(x), bool)
    for r in rings:
        a, b = r, np.roll(r, -1, axis=0)
        for (ax, ay), (bx, by) in zip(a, b, strict=True):
            if ay != by:
                hit ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return hit


def distance(rings: list[np.ndarray], x: np.ndarray, y: np.ndarray, to_edge: bool = False) -> np.ndarray:
    """Distance of points to the polygon (0 inside), or to its edge."""
    d = np.full(len(x), np.inf)
    for r in rings:
        for (ax, ay), (bx, by) in zip(r, np.roll(r, -1, axis=0), strict=True):
            dx, dy = bx - ax, by - ay
            n = dx * dx + dy * dy
            t = np.clip(((x - ax) * dx + (y - ay) * dy) / n, 0, 1) if n else np.zeros(len(x))
            d = np.minimum(d, np.hypot(x - ax - t * dx, y - ay - t * dy))
    return d if to_edge else np.where(inside(rings, x, y), 0.0, d)


def coverage(rings: list[np.ndarray], x0: float, y0: float, size: float, rows: int, cols: int) -> np.ndarray:
    """GE3, JN6: exact share of each cell of a north-up grid (x0, y0: its upper left corner). Slivers are 0; a grid of more than
    MAX_COVERAGE_CELLS cells gets the binary target instead."""
    if rows * cols > C.MAX_COVERAGE_CELLS:
        return binary_target(rings, x0, y0, size, rows, cols)
    j, i = np.meshgrid(np.arange(cols), np.arange(rows))
    x, y = (x0 + (j + 0.5) * size).ravel(), (y0 - (i + 0.5) * size).ravel()
    # Cells whose centre is farther from the edge than half a diagonal are whole or empty; only the others are cut.
    out = inside(rings, x, y).astype(float)
    for k in np.flatnonzero(distance(rings, x, y, to_edge=True) < size * 0.7072).tolist():
        left, top = x[k] - size / 2, y[k] + size / 2
        parts = [clip(r, left, top - size, left + size, top) for r in rings]
        areas = [abs(ring_area(p)) if len(p) >= 3 else 0.0 for p in parts]
        out[k] = (areas[0] - sum(areas[1:])) / size**2
    out = out.reshape(rows, cols)
    out[out < C.MIN_CELL_COVERAGE] = 0.0
    return np.minimum(out, 1.0)


def binary_target(rings: list[np.ndarray], x0: float, y0: float, size: float, rows: int, cols: int) -> np.ndarray:
    """GE4: 1 for every cell that the polygon touches: its centre is inside, or an edge crosses the cell. Edge by edge, over the
    cells of the edge's own box, so that memory is that of the grid."""
    j, i = np.meshgrid(np.arange(cols), np.arange(rows))
    out = inside(rings, (x0 + (j + 0.5) * size).ravel(), (y0 - (i + 0.5) * size).ravel()).reshape(rows, cols)
    # In units of cells, down and right from the upper left corner.
    grid = [np.stack([(r[:, 0] - x0) / size, (y0 - r[:, 1]) / size], axis=1) for r in rings]
    for r in grid:
        for (ax, ay), (bx, by) in zip(r, np.roll(r, -1, axis=0), strict=True):
            c0, c1 = max(math.floor(min(ax, bx)), 0), min(math.ceil(max(ax, bx)), cols)
            r0, r1 = max(math.floor(min(ay, by)), 0), min(math.ceil(max(ay, by)), rows)
            if c0 >= c1 or r0 >= r1:
                continue
            cx, cy = np.arange(c0, c1)[None, :] + 0.5, np.arange(r0, r1)[:, None] + 0.5
            dx, dy = bx - ax, by - ay
            # The edge's line passes through the open cell when its corners are not all on one side.
            off = np.abs((cx - ax) * dy - (cy - ay) * dx)
            out[r0:r1, c0:c1] |= off < 0.5 * (abs(dx) + abs(dy))
    return out.astype(float)


def is_convex(r: np.ndarray) -> bool:
    d = np.roll(r, -1, axis=0) - r
    z = d[:, 0] * np.roll(d[:, 1], -1) - d[:, 1] * np.roll(d[:, 0], -1)
    return bool((z >= -1e-9).all() or (z <= 1e-9).all())


def shrink(ring: np.ndarray, by: float) -> np.ndarray:
    """Inward offset of a convex ring: the cut by each side's half plane moved inward. Exact."""
    if ring_area(ring) < 0:
        ring = ring[::-1]
    pts = ring
    for a, b in zip(ring, np.roll(ring, -1, axis=0), strict=True):
        d = b - a
        n = math.hypot(*d)
        if not n or len(pts) < 3:
            continue
        normal = np.array([-d[1], d[0]]) / n
        s = (pts - a) @ normal - by
        nxt, sn = np.roll(pts, -1, axis=0), np.roll(s, -1)
        out = []
        for p, q, u, v in zip(pts, nxt, s, sn, strict=True):
            if u >= 0:
                out.append(p)
            if (u >= 0) != (v >= 0):
                out.append(p + (q - p) * (u / (u - v)))
        pts = np.array(out) if out else np.zeros((0, 2))
    return pts


def erode(rings: list[np.ndarray], by: float = -C.FIELD_BUFFER_M) -> tuple[list[np.ndarray], bool, bool]:
    """GE2: (rings, eroded, exact). Fields below the limit stay; so do those that would vanish or shrink below the least area.
    A concave field or one with holes keeps its rings and is to be eroded by distance (eroded True, exact False)."""
    if area(rings) < C.ADAPTIVE_EROSION_MIN_AREA_M2:
        return rings, False, True
    if len(rings) > 1 or not is_convex(rings[0]):
        return rings, True, False
    small = shrink(rings[0], by)
    if len(small) < 3 or abs(ring_area(small)) < C.MIN_BUFFERED_AREA_M2:
        return rings, False, True
    return [small], True, True


def context_buffer(rings: list[np.ndarray], target_m2: float, most_m: float = 2000.0, steps: int = 28) -> float:
    """GE7: the smallest buffer that brings a convex hull's area to the target, by halving, at most most_m."""
    a, p = area(rings), float(np.hypot(*(np.roll(rings[0], -1, axis=0) - rings[0]).T).sum())
    total = lambda b: a + p * b + math.pi * b * b
    if a >= target_m2:
        return 0.0
    lo, hi = 0.0, most_m
    if total(hi) < target_m2:
        return most_m
    for _ in range(steps):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if total(mid) >= target_m2 else (mid, hi)
    return hi


MAX_ENDMEMBERS = 10


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Non-negative least squares of many right sides at once: a is bands x endmembers, b rows x bands; gives rows x endmembers. The
    optimum is the plain solution on the endmembers it uses, so of every subset's solutions the best non-negative one is taken."""
    n = a.shape[1]
    if n > MAX_ENDMEMBERS:
        raise ValueError(f"at most {MAX_ENDMEMBERS} endmembers")
    best, x = (b * b).sum(axis=1), np.zeros((len(b), n))
    for k in range(1, n + 1):
        for used in itertools.combinations(range(n), k):
            s = b @ np.linalg.pinv(a[:, used]).T
            rss = ((b - s @ a[:, used].T) ** 2).sum(axis=1)
            better = (s >= 0).all(axis=1) & (rss < best)
            best[better] = rss[better]
            row = np.zeros((int(better.sum()), n))
            row[:, used] = s[better]
            x[better] = row
    return x


def unmix(df: DataFrame, spectrum: str, endmembers: dict[str, list[float]]) -> DataFrame:
    """GE13: shares of the endmembers in each spectrum, summing to 1, and the RMSE; NULL for spectra of another length or not finite."""
    reach_workers(df.sparkSession)
    names, e = list(endmembers), np.array(list(endmembers.values()), float).T

    @pandas_udf("fractions array<double>, rmse double")
    def run(s: pd.Series) -> pd.DataFrame:
        rows = [None if v is None or len(v) != len(e) else np.asarray(v, float) for v in s]
        ok = np.array([v is not None and bool(np.isfinite(v).all()) for v in rows], bool)
        out = pd.DataFrame({"fractions": [None] * len(rows), "rmse": [None] * len(rows)}, dtype=object)
        if ok.any():
            b = np.stack([v for v, good in zip(rows, ok, strict=True) if good])
            x = nnls(e, b)
            rmse, total = np.sqrt(((x @ e.T - b) ** 2).mean(axis=1)), x.sum(axis=1)
            for i, at in enumerate(np.nonzero(ok)[0]):
                out.iat[at, 0] = (x[i] / total[i]).tolist() if total[i] > 0 else None
                out.iat[at, 1] = float(rmse[i])
        return out

    u = df.withColumn("u", run(F.col(spectrum)))
    return u.select(*df.columns, *[F.element_at("u.fractions", k + 1).alias(n) for k, n in enumerate(names)], F.col("u.rmse").alias("rmse"))


def resolve_geometry(candidates: list[Column], old: Column, lat: Column, lon: Column, half: float = 0.00036) -> Column:
    """GE1: struct(geojson, confidence): the first usable candidate is high, the old boundary medium, a disc around the centre low."""
    good = lambda c: F.when(F.get_json_object(c, "$.type").isin("Polygon", "MultiPolygon") & F.get_json_object(c, "$.coordinates[0]").isNotNull(), c)
    high, medium = F.coalesce(*[good(c) for c in candidates]), good(old)
    point = lambda a, b: F.concat(F.lit("["), (lon + a * half).cast("string"), F.lit(","), (lat + b * half).cast("string"), F.lit("]"))
    turns = [(math.cos(2 * math.pi * k / 64), math.sin(2 * math.pi * k / 64)) for k in (*range(64), 0)]
    disc = F.concat(F.lit('{"type":"Polygon","coordinates":[['), F.concat_ws(",", *[point(a, b) for a, b in turns]), F.lit("]]}"))
    low = F.when(lat.isNotNull() & lon.isNotNull(), disc)
    word = F.when(high.isNotNull(), "high").when(medium.isNotNull(), "medium").when(low.isNotNull(), "low")
    return F.struct(F.coalesce(high, medium, low).alias("geojson"), word.alias("confidence"))


def spread(parcels: DataFrame) -> DataFrame:
    """Parcels dealt over all tasks: their rows are small, what is done to each is not."""
    return parcels.repartition(int(parcels.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def cover_cells(parcels: DataFrame, key: str, geojson: str, size: float = 10.0) -> DataFrame:
    """(key, row, col, x, y, coverage, distance_inside) for the cells of each parcel on the world grid of `size` metres: row and
    col count from the origin, so parcels share cells. distance_inside is the cell centre's distance to the edge."""
    reach_workers(parcels.sparkSession)
    kind = parcels.schema[key].dataType

    def run(batches):
        for batch in batches:
            for k, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rings = rings_of(g)
                if rings is None:
                    continue
                c0, r0 = math.floor(rings[0][:, 0].min() / size), math.floor(-rings[0][:, 1].max() / size)
                c1, r1 = math.floor(rings[0][:, 0].max() / size) + 1, math.floor(-rings[0][:, 1].min() / size) + 1
                w = coverage(rings, c0 * size, -r0 * size, size, r1 - r0, c1 - c0)
                i, j = np.nonzero(w)
                x, y = (c0 + j + 0.5) * size, -(r0 + i + 0.5) * size
                yield pa.RecordBatch.from_pydict({"k": [k] * len(i), "row": (r0 + i).astype(np.int64), "col": (c0 + j).astype(np.int64), "x": x, "y": y, "coverage": w[i, j], "distance_inside": distance(rings, x, y, to_edge=True)})

    from pyspark.sql.types import DoubleType, LongType, StructType

    schema = StructType().add("k", kind).add("row", LongType()).add("col", LongType())
    for c in ("x", "y", "coverage", "distance_inside"):
        schema = schema.add(c, DoubleType())
    return spread(parcels.select(key, geojson)).mapInArrow(run, schema).withColumnRenamed("k", key)


def ring_cells(parcels: DataFrame, key: str, geojson: str, size: float = 10.0, gap: float = C.RING_GAP_M, most: float = C.RING_MAX_M) -> DataFrame:
    """JN7, GE8: (key, row, col, distance) of the grid cells between `gap` and `most` metres off each parcel."""
    reach_workers(parcels.sparkSession)
    kind = parcels.schema[key].dataType

    def run(batches):
        for batch in batches:
            for k, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rings = rings_of(g)
                if rings is None:
                    continue
                lo, hi = rings[0].min(axis=0) - most, rings[0].max(axis=0) + most
                c, r = np.arange(math.floor(lo[0] / size), math.floor(hi[0] / size) + 1), np.arange(math.floor(-hi[1] / size), math.floor(-lo[1] / size) + 1)
                j, i = (a.ravel() for a in np.meshgrid(c, r))
                d = distance(rings, (j + 0.5) * size, -(i + 0.5) * size)
                ok = (d >= gap) & (d <= most)
                yield pa.RecordBatch.from_pydict({"k": [k] * int(ok.sum()), "row": i[ok].astype(np.int64), "col": j[ok].astype(np.int64), "distance": d[ok]})

    from pyspark.sql.types import DoubleType, LongType, StructType

    schema = StructType().add("k", kind).add("row", LongType()).add("col", LongType()).add("distance", DoubleType())
    return spread(parcels.select(key, geojson)).mapInArrow(run, schema).withColumnRenamed("k", key)


def ring_width(cells: DataFrame, key: str, dist: str) -> DataFrame:
    """WN10: the smallest ring, in steps of 10 m, with enough clean cells; the widest when none has. Adds ring_m and keeps its cells."""
    step = F.greatest(F.ceil(F.col(dist) / C.RING_STEP_M) * C.RING_STEP_M, F.lit(C.RING_GAP_M + C.RING_STEP_M))
    counts = cells.groupBy(key, step.alias("ring")).agg(F.count("*").alias("n"))
    run = F.sum("n").over(Window.partitionBy(key).orderBy("ring"))
    ring = counts.withColumn("run", run).groupBy(key).agg(F.coalesce(F.min(F.when((F.col("run") >= C.RING_PX_REAL) & (F.col("ring") < C.RING_MAX_M), F.col("ring"))), F.lit(C.RING_MAX_M)).alias("ring_m"))
    return cells.join(ring, key).where(F.col(dist) <= F.col("ring_m"))


def ring_tier(n: Column) -> Column:
    return F.when(n >= C.RING_PX_REAL, "real").when(n >= C.RING_PX_MIN, "indicative").otherwise("insufficient_context")


def plan_blocks(lands: DataFrame, land: str, x0: str, y0: str, x1: str, y1: str, lat0: float, span: float = C.BLOCK_SPAN_M, most: int = C.BLOCK_MAX_LANDS) -> DataFrame:
    """GE11: (land, block_x, block_y, chunk): cells of a local metric grid, at most `most` lands each by id; a larger parcel alone."""
    kx, ky = 111320.0 * math.cos(math.radians(lat0)), 110540.0
    wide = F.greatest((F.col(x1) - F.col(x0)) * kx, (F.col(y1) - F.col(y0)) * ky) > span
    cell = lambda a, b, k: F.floor((F.col(a) + F.col(b)) / 2 * k / span)
    own = lands.select(land, wide.alias("own"), cell(x0, x1, kx).alias("block_x"), cell(y0, y1, ky).alias("block_y"))
    n = F.row_number().over(Window.partitionBy("own", "block_x", "block_y").orderBy(F.col(land).cast("string")))
    chunk = F.when(F.col("own"), -n).otherwise(F.floor((n - 1) / most)).cast("int")
    return own.select(land, "own", "block_x", "block_y", chunk.alias("chunk"))


def group_bounds(df: DataFrame, key: str, x0: str, y0: str, x1: str, y1: str) -> DataFrame:
    """GE9-GE10, ST5: the box of each group."""
    return df.groupBy(key).agg(F.min(x0).alias("x0"), F.min(y0).alias("y0"), F.max(x1).alias("x1"), F.max(y1).alias("y1"), F.count("*").alias("n"))


BLOCK, SLICES, TASKS = 1024, 16, 128


def box_join(left: DataFrame, right: DataFrame, group: list[str], tile: float, keep_unknown: bool = True) -> DataFrame:
    """JN4-JN5: pairs of a group whose boxes (x0, y0, x1, y1) meet; rows of the right without a box meet all of their group. Boxes
    are dealt to the tiles they cover; a pair counts in the tile of its lower left corner. Rows without a box, whose pairs are all of
    their group, meet it in blocks of some BLOCK rows of the left and in SLICES of the right, so that no group is one task. Pairs come
    out by row of the right: they are then written as long runs of the one and short repeats of the other."""
    names = ("x0", "y0", "x1", "y1")
    span = lambda a, b: F.sequence(F.floor(F.col(a) / tile), F.floor(F.col(b) / tile))

    def dealt(df: DataFrame, side: str) -> DataFrame:
        d = df.select(*[F.col(c).alias(f"{side}_{c}") if c in names else F.col(c) for c in df.columns]).where(f"{side}_x0 is not null")
        return d.withColumn("tx", F.explode(span(f"{side}_x0", f"{side}_x1"))).withColumn("ty", F.explode(span(f"{side}_y0", f"{side}_y1")))

    j = dealt(right, "r").join(dealt(left, "l"), [*group, "tx", "ty"])
    meet = (F.col("l_x0") <= F.col("r_x1")) & (F.col("r_x0") <= F.col("l_x1")) & (F.col("l_y0") <= F.col("r_y1")) & (F.col("r_y0") <= F.col("l_y1"))
    once = (F.col("tx") == F.floor(F.greatest("l_x0", "r_x0") / tile)) & (F.col("ty") == F.floor(F.greatest("l_y0", "r_y0") / tile))
    own = [*group, *[c for d in (left, right) for c in d.columns if c not in names and c not in group]]
    out = j.where(meet & once).select(*own)
    if not keep_unknown:
        return out
    sizes = left.groupBy(*group).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    parts = left.withColumn("hash", F.xxhash64(*left.columns)).join(sizes, group).withColumn("block", F.pmod("hash", "blocks"))
    unknown = right.where("x0 is null").drop(*names).join(sizes, group).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    unknown = unknown.withColumn("slice", F.pmod(F.xxhash64(*unknown.columns[:-2]), F.lit(SLICES)))
    parts = parts.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))))
    keys = [*group, "block", "slice"]
    apart = lambda df: df.repartition(TASKS, *keys)  # noqa: E731 - by number: Spark would merge these by their few bytes
    every = apart(unknown.drop("blocks")).join(apart(parts.drop(*names, "hash", "blocks")).hint("merge"), keys)
    return out.unionByName(every.select(*own))
