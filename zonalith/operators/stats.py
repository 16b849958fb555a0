"""Zonal statistics over long cell tables: one row per cell, one group per field and scene.

Every operator pre-aggregates by group; quantiles use one window per group over its cells, ordered by (value, weight) so
that ties cannot change a result. All standard deviations are of the population. NULL values and weights of 0 or less
take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonalith import constants as C


#: The decimal of a weight below a million, to 12 places.
EXACT = "decimal(18,12)"


def exact(weight: Column) -> Column:
    """A weight below a million to 12 places, as a decimal: sums of it are the same in any order of the rows."""
    return weight.cast(EXACT)


def unweighted_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """AG1: mean, median, min, max, std, p10, p90, cv, n."""
    v = F.col(value)
    out = df.where(v.isNotNull()).groupBy(*keys).agg(
        F.avg(v).alias("mean"),
        percentiles(v).alias("p"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.stddev_pop(v).alias("std"),
        F.count(v).alias("n"),
    )
    out = out.select(*keys, "mean", F.col("p")[1].alias("median"), "min", "max", "std", F.col("p")[0].alias("p10"), F.col("p")[2].alias("p90"), "n")
    return out.withColumn("cv", F.col("std") / (F.abs("mean") + C.EPS))


def percentiles(value: Column) -> Column:
    """p10, median and p90 as one aggregate, so that a group's values are held once."""
    return F.percentile(value, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))


def _midpoints(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per cell: q, the share of weight below its midpoint, with the next cell's value and share."""
    order = Window.partitionBy(*keys).orderBy("v", "w")
    up_to = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    df = df.withColumn("q", (F.sum("w").over(up_to) - F.col("w") / 2) / F.sum("w").over(whole))
    return df.withColumn("next_v", F.lead("v").over(order)).withColumn("next_q", F.lead("q").over(order)).withColumn("rn", F.row_number().over(order))


def midpoint_quantile(p: float) -> Column:
    """WN4 as an aggregate over rows of _midpoints: linear between midpoints, the end values beyond them."""
    q, nq, v, nv = (F.col(c) for c in ("q", "next_q", "v", "next_v"))
    inside = F.when((q <= p) & (p < nq), v + (nv - v) * (p - q) / (nq - q))
    low = F.min(F.when((F.col("rn") == 1) & (q > p), v))
    high = F.max(F.when(nq.isNull() & (q <= p), v))
    return F.coalesce(F.max(inside), low, high)


def weighted_stats(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """AG2: the coverage-weighted statistics of a field, with effective pixels, purity, Kish size and standard error."""
    own = df.select(*keys, F.col(value).alias("v"), F.col(weight).cast("double").alias("w")).where("v is not null and w > 0")
    cells = _midpoints(own, keys)
    mean = F.sum(F.col("v") * F.col("w")).over(Window.partitionBy(*keys)) / F.sum("w").over(Window.partitionBy(*keys))
    cells = cells.withColumn("m", mean)
    d = F.col("v") - F.col("m")
    out = cells.groupBy(*keys).agg(
        F.max("m").alias("mean"),
        F.sqrt(F.sum(F.col("w") * d * d) / F.sum("w")).alias("std"),
        midpoint_quantile(0.1).alias("p10"),
        midpoint_quantile(0.5).alias("median"),
        midpoint_quantile(0.9).alias("p90"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.sum("w").alias("epc"),
        F.count("*").alias("n_cells"),
        F.coalesce(F.sum(F.when(F.col("w") >= C.INTERIOR_COVERAGE, F.col("w"))), F.lit(0.0)).alias("interior_epc"),
        F.sum(F.col("w") * F.col("w")).alias("w2"),
    )
    n_eff = F.col("epc") * F.col("epc") / F.col("w2")
    return out.select(
        *keys,
        *["mean", "std", "p10", "median", "p90", "min", "max", "epc", "n_cells", "interior_epc"],
        F.when(F.abs("mean") > C.EPS, F.col("std") / F.abs("mean")).alias("cv"),
        (F.col("epc") / F.col("n_cells")).alias("purity"),
        (F.col("interior_epc") / F.col("epc")).alias("interior_share"),
        (1.0 - F.col("interior_epc") / F.col("epc")).alias("boundary_share"),
        n_eff.alias("n_eff"),
        (F.col("std") / F.sqrt(n_eff)).alias("se"),
    )


def bin_index(value: Column, lo: float, hi: float, bins: int) -> Column:
    """The bin of a value by comparison with the real edges; the last bin is closed; NULL outside."""
    edges = F.array(*[F.lit(lo + (hi - lo) * k / bins) for k in range(bins + 1)])
    at = F.least(F.size(F.filter(edges, lambda e: e <= value)), F.lit(bins)) - 1
    return F.when((value >= lo) & (value <= hi), at)


def weighted_histogram(df: DataFrame, keys: Sequence[str], value: str, weight: str, lo: float = -1.0, hi: float = 1.0, bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    """AG3 as rows: keys, bin, total weight; every bin of every group. Weights are summed exactly, to 12 places."""
    own = df.select(*keys, bin_index(F.col(value), lo, hi, bins).alias("bin"), F.col(weight).alias("w")).where("w > 0 and bin is not null")
    sums = own.groupBy(*keys, "bin").agg(F.sum(exact(F.col("w"))).cast("double").alias("count"))
    every = sums.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(sums, [*keys, "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0.0)))


def histogram_struct(hist: DataFrame, keys: Sequence[str], lo: float = -1.0, hi: float = 1.0, bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    """The rows of weighted_histogram as one struct of edges and counts."""
    counts = F.transform(F.array_sort(F.collect_list(F.struct("bin", "count"))), lambda x: x["count"])
    edges = F.array(*[F.lit(lo + (hi - lo) * k / bins) for k in range(bins + 1)])
    return hist.groupBy(*keys).agg(counts.alias("counts")).select(*keys, F.struct(edges.alias("bins"), "counts", F.lit("coverage").alias("weighting")).alias("histogram"))


def histogram_stats(hist: Column) -> Column:
    """AG4 on a struct of edges and counts: mean, std, p10, p50, p90, uniformity_cv, pixels; NULL when malformed or empty. Which bin
    reaches a share is told by decimal sums, so that a bin that ends right on the share is the one."""
    bins, counts, kind = hist["bins"], hist["counts"], "decimal(30,12)"
    mids = F.transform(F.sequence(F.lit(1), F.size(counts)), lambda i: (F.element_at(bins, i) + F.element_at(bins, i + 1)) / 2)
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    pairs = F.zip_with(mids, counts, lambda m, c: F.struct(m.alias("m"), c.cast("double").alias("c")))
    mean = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x["m"] * x["c"]) / total
    var = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x["c"] * (x["m"] - mean) * (x["m"] - mean)) / total

    plus = lambda s, c: (s + c.cast(kind)).cast(kind)
    whole = F.aggregate(counts, F.lit(0).cast(kind), plus)

    def quantile(p: str) -> Column:
        start = F.struct(F.lit(0).cast(kind).alias("run"), F.lit(None).cast("double").alias("hit"), (whole * F.lit(Decimal(p))).alias("need"))
        run = lambda s, x: plus(s["run"], x["c"])
        step = lambda s, x: F.struct(run(s, x).alias("run"), F.when(s["hit"].isNull() & (run(s, x) >= s["need"]), x["m"]).otherwise(s["hit"]).alias("hit"), s["need"].alias("need"))
        return F.coalesce(F.aggregate(pairs, start, step)["hit"], F.element_at(mids, -1))

    good = bins.isNotNull() & counts.isNotNull() & (F.size(counts) > 0) & (F.size(bins) == F.size(counts) + 1)
    made = F.struct(
        F.round(mean, 4).alias("mean"),
        F.round(F.sqrt(var), 4).alias("std"),
        F.round(quantile("0.1"), 4).alias("p10"),
        F.round(quantile("0.5"), 4).alias("p50"),
        F.round(quantile("0.9"), 4).alias("p90"),
        F.round(F.sqrt(var) / (F.abs(mean) + C.EPS), 4).alias("uniformity_cv"),
        total.alias("pixels"),
    )
    return F.when(good & (total != 0), made)


def scl_class(code: Column) -> Column:
    """FLT3: the class of a cell, in order of precedence."""
    return (
        F.when(code.isin(*C.SCL_CLOUD), "cloud")
        .when(code.isin(*C.SCL_SHADOW), "shadow")
        .when(code.isin(*C.SCL_WATER), "water")
        .when(code.isin(*C.SCL_SATURATED), "saturated")
        .when(code.isin(*C.SCL_SNOW), "snow")
        .when(code.isin(*C.SCL_CROP), "crop")
        .otherwise("unaccounted")
    )


def crop_mask(value: Column, code: Column) -> Column:
    """FLT2: the value where the cell is crop surface."""
    return F.when(scl_class(code) == "crop", value)


def suppress_slivers(coverage: Column) -> Column:
    """FLT4."""
    return F.when(coverage < C.MIN_CELL_COVERAGE, 0.0).otherwise(coverage)


def mask_fractions(df: DataFrame, keys: Sequence[str], code: str, weight: str) -> DataFrame:
    """AG5: share of each class in the field's weight, cell counts and effective pixels. Cells without a code, or with that of
    no data, are not of the field. Dark cells are a part of the shadow as well. A field without a cell has shares of 0."""
    w = F.when((F.col(weight) > 0) & (F.col(code) != C.SCL_NO_DATA), F.col(weight))
    kind = F.when(w.isNotNull(), scl_class(F.col(code)))
    whole = lambda x: F.coalesce(F.sum(x), F.lit(0.0))
    share = lambda name, of: F.coalesce(F.try_divide(whole(F.when(of, w)), F.sum(w)), F.lit(0.0)).alias(f"{name}_fraction")
    return df.groupBy(*keys).agg(
        *[share(n, kind == n) for n in ("cloud", "shadow", "water", "saturated", "snow", "crop", "unaccounted")],
        share("dark", F.col(code).isin(*C.SCL_DARK)),
        F.count(w).alias("n_field_pixels"),
        F.count_if(kind == "crop").alias("n_crop_pixels"),
        whole(w).alias("epc_total"),
        whole(F.when(kind == "crop", w)).alias("epc_crop"),
    )


def radar_stats(df: DataFrame, keys: Sequence[str], vv: str, vh: str, weight: str) -> DataFrame:
    """AG6: weighted means of rvi, cross ratio, vv and vh (dB after averaging), std of rvi, n, epc."""
    from zonalith.functions.spectral import decibel, radar

    r = radar(F.col(vv), F.col(vh))
    own = df.select(*keys, r["rvi"].alias("rvi"), r["cross_ratio"].alias("cr"), F.col(vv).alias("vv"), F.col(vh).alias("vh"), F.col(weight).alias("w")).where("w > 0 and rvi is not null")
    mean = lambda c: F.sum(F.col(c) * F.col("w")) / F.sum("w")
    own = own.withColumn("m", F.sum(F.col("rvi") * F.col("w")).over(Window.partitionBy(*keys)) / F.sum("w").over(Window.partitionBy(*keys)))
    return own.groupBy(*keys).agg(
        mean("rvi").alias("rvi_mean"),
        F.sqrt(F.sum(F.col("w") * (F.col("rvi") - F.col("m")) * (F.col("rvi") - F.col("m"))) / F.sum("w")).alias("rvi_std"),
        decibel(mean("cr")).alias("cross_ratio_db"),
        decibel(mean("vv")).alias("vv_db"),
        decibel(mean("vh")).alias("vh_db"),
        F.count("*").alias("n"),
        F.sum("w").alias("epc"),
    )


def _spread(df: DataFrame, keys: Sequence[str], value: str, weight: str, points: dict[str, float]) -> DataFrame:
    """Per cell: v, w, the lower step quantiles of its group by name (the first value whose share of weight reaches p), d, the
    distance from `median`, and d_share. The windows have one partitioning, so the cells move once."""
    own = df.select(*keys, F.col(value).alias("v"), F.col(weight).alias("w")).where("v is not null and w > 0")
    whole = Window.partitionBy(*keys)
    up_to = lambda x: whole.orderBy(x, "w").rowsBetween(Window.unboundedPreceding, 0)
    cells = own.withColumn("total", F.sum("w").over(whole)).withColumn("share", F.sum("w").over(up_to("v")) / F.col("total"))
    cells = cells.withColumns({n: F.min(F.when(F.col("share") >= p, F.col("v"))).over(whole) for n, p in points.items()})
    cells = cells.withColumn("d", F.abs(F.col("v") - F.col("median")))
    return cells.withColumn("d_share", F.sum("w").over(up_to("d")) / F.col("total"))


def robust_location(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """AG7: weighted median and median absolute deviation."""
    cells = _spread(df, keys, value, weight, {"median": 0.5})
    return cells.groupBy(*keys).agg(F.max("median").alias("median"), F.min(F.when(F.col("d_share") >= 0.5, F.col("d"))).alias("mad"))


def context_summary(df: DataFrame, keys: Sequence[str], value: str, weight: str, parcel: DataFrame | None = None, parcel_value: str = "parcel_ndvi") -> DataFrame:
    """AG8: cells, weight, median, MAD, step p10 and p90, and the parcel's robust z against them (0 or signed infinity at MAD 0)."""
    points = {"p10": 0.1, "median": 0.5, "p90": 0.9}
    out = _spread(df, keys, value, weight, points).groupBy(*keys).agg(
        F.count("*").alias("n_cells"),
        F.sum("w").alias("effective_cells"),
        F.min(F.when(F.col("d_share") >= 0.5, F.col("d"))).alias("mad"),
        *[F.max(n).alias(n) for n in points],
    )
    if parcel is None:
        return out
    out = out.join(parcel.select(*keys, F.col(parcel_value).alias("parcel")), list(keys), "left")
    delta = F.col("parcel") - F.col("median")
    z = F.when(F.col("mad") > 1e-9, delta / (1.4826 * F.col("mad"))).when(F.abs(delta) < 1e-9, 0.0).otherwise(F.signum(delta) * float("inf"))
    return out.withColumn("delta", delta).withColumn("robust_z", F.when(delta.isNotNull(), z)).drop("parcel")


def layer_stats(df: DataFrame, keys: Sequence[str], layers: dict[str, Column], visible: Column) -> DataFrame:
    """AG9 and CD6: unweighted statistics of several layers, unpivoted to a row for each, with the valid share of visible cells."""
    items = F.array(*[F.struct(F.lit(n).alias("layer_code"), c.alias("value")) for n, c in layers.items()])
    own = df.where(visible).select(*keys, F.explode(items).alias("x")).select(*keys, "x.*")
    out = own.groupBy(*keys, "layer_code").agg(
        F.avg("value").alias("mean"),
        percentiles(F.col("value")).alias("p"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        (F.count("value") / F.count("*")).alias("valid_fraction"),
        F.count("value").alias("n_valid"),
    )
    return out.select(*keys, "layer_code", "mean", F.col("p")[1].alias("median"), F.col("p")[0].alias("p10"), F.col("p")[2].alias("p90"), "min", "max", "valid_fraction", "n_valid")


def dilate(df: DataFrame, keys: Sequence[str], row: str, col: str, code: str, rounds: int = 1) -> DataFrame:
    """GE5: cloud grows to 9 and cloud shadow to 3 over `rounds` steps to the four neighbours, onto every cell but those of no data
    and those of cloud, which stay as they are; cloud wins. What a cell can reach in so many steps is dealt out at once."""
    place = [*keys, row, col]
    kind = F.when(F.col(code).isin(*C.SCL_CLOUD), 2).when(F.col(code).isin(*C.SCL_CLOUD_SHADOW), 1)
    reach = [(a, b) for a in range(-rounds, rounds + 1) for b in range(-rounds, rounds + 1) if 0 < abs(a) + abs(b) <= rounds]
    if not reach:
        return df
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in reach])
    grown = df.where(kind.isNotNull()).select(*keys, F.col(row), F.col(col), kind.alias("k"), F.explode(steps).alias("s"))
    grown = grown.select(*keys, (F.col(row) + F.col("s.a")).alias(row), (F.col(col) + F.col("s.b")).alias(col), "k").groupBy(*place).agg(F.max("k").alias("k"))
    open_ = (F.col(code) != C.SCL_NO_DATA) & ~F.col(code).isin(*C.SCL_CLOUD)
    new = F.when(open_ & (F.col("k") == 2), 9).when(open_ & (F.col("k") == 1), 3).otherwise(F.col(code))
    return df.join(grown, place, "left").withColumn(code, new).drop("k")
