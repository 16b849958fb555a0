"""AG15: effective sample size from the empirical semivariogram of a field."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from zonalith.session import reach_workers

SCHEMA = "n_eff double, se double, range_cells double, sill double, nugget double, method string"


PAIRS_A_BLOCK = 1 << 21
STEP = 16


def quantiles(blocks: Callable[[], Iterable[np.ndarray]], count: int, p: float) -> float:
    """np.percentile (linear) of `count` non-negative numbers that come in blocks, by radix selection on their bits: non-negative
    doubles order as their bit patterns do. A block and two histograms are held at a time."""
    at = (count - 1) * p
    found = []
    for rank in (int(at), min(int(at) + 1, count - 1)):
        prefix = 0
        for shift in range(64 - STEP, -1, -STEP):
            seen = np.zeros(1 << STEP, np.int64)
            for x in blocks():
                bits = x.view(np.uint64)
                if shift < 64 - STEP:
                    bits = bits[bits >> np.uint64(shift + STEP) == prefix]
                seen += np.bincount((bits >> np.uint64(shift) & np.uint64((1 << STEP) - 1)).astype(np.int64), minlength=1 << STEP)
            up_to = np.cumsum(seen)
            digit = int(np.searchsorted(up_to, rank, side="right"))
            rank -= int(up_to[digit] - seen[digit])
            prefix = prefix << STEP | digit
        found.append(float(np.array([prefix], np.uint64).view(np.float64)[0]))
    lo, hi = found
    t = at - int(at)
    return lo + (hi - lo) * t if t < 0.5 else hi - (hi - lo) * (1 - t)


def pairs(r: np.ndarray, c: np.ndarray, v: np.ndarray, most: int = PAIRS_A_BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distance, semivariance) of all pairs of cells, about `most` at a time."""
    n, a = len(v), 0
    while a < n - 1:
        b = min(n - 1, a + max(1, most // (n - a)))
        later = np.arange(a + 1, n)[None, :] > np.arange(a, b)[:, None]
        d = np.hypot(r[a:b, None] - r[None, a + 1 :], c[a:b, None] - c[None, a + 1 :])
        yield d[later], (0.5 * (v[a:b, None] - v[None, a + 1 :]) ** 2)[later]
        a = b


def kernel(r: np.ndarray, c: np.ndarray, v: np.ndarray, w: np.ndarray, most: int = PAIRS_A_BLOCK) -> tuple:
    """(n_eff, se, range, sill, nugget, method) over all pairs of cells, in blocks of about `most` pairs."""
    if not len(v):
        return 0.0, None, None, None, None, "insufficient"
    kish = float(w.sum() ** 2 / (w * w).sum())
    if len(v) < 4 or v.std() <= 1e-9:
        return kish, 0.0 if len(v) >= 2 else None, None, None, None, "insufficient_variogram_support_kish"
    count = len(v) * (len(v) - 1) // 2
    held = [tuple(np.concatenate(x) for x in zip(*pairs(r, c, v, most), strict=True))] if count <= most else None
    every = lambda: held or pairs(r, c, v, most)
    of = (lambda make, _, p: float(np.quantile(next(iter(make())), p))) if held else quantiles
    sill = of(lambda: (g for _, g in every()), count, 0.9)
    near = of(lambda: (d for d, _ in every()), count, 0.25)
    close = sum(int((d <= near).sum()) for d, _ in every())
    nugget = of(lambda: (g[d <= near] for d, g in every()), close, 0.1)
    level = nugget + 0.95 * max(sill - nugget, 0.0)
    first = min((float(d[g >= level].min(initial=math.inf)) for d, g in every()), default=math.inf)
    if math.isinf(first):
        return kish, None, None, None, None, "unresolved_range_kish"
    span = max(first, 1.0)
    n = max(1.0, min(kish, float(w.sum()) / (math.pi * span * span)))
    mean = float((v * w).sum() / w.sum())
    se = math.sqrt(float((w * (v - mean) ** 2).sum() / w.sum()) / n)
    return n, se, span, sill, nugget, "empirical_variogram"


def support(df: DataFrame, key: str, row: str, col: str, value: str, weight: str) -> DataFrame:
    """One row for each field. A task holds a field's cells and a block of their pairs; its time grows with the pairs."""
    reach_workers(df.sparkSession)
    own = df.selectExpr(f"{key} as k", f"cast({row} as double) as r", f"cast({col} as double) as c", f"cast({value} as double) as v", f"cast({weight} as double) as w").where("v is not null and not isnan(v) and w > 0")

    def run(t: pa.Table) -> pa.Table:
        out = kernel(*(t.column(x).to_numpy() for x in "rcvw"))
        return pa.table({"k": t.column("k").slice(0, 1), **{n.split(" ")[0]: pa.array([x], pa.string() if n.endswith("string") else pa.float64()) for n, x in zip(SCHEMA.split(", "), out, strict=True)}})

    kind = own.schema["k"].dataType.simpleString()
    return own.groupBy("k").applyInArrow(run, f"k {kind}, {SCHEMA}").withColumnRenamed("k", key)
