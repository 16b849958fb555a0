"""Series per field: trend, regression, outliers, as-of lookups and bounded forecasts.

A series is rows (key, date, value). Windows are per key; outlier search buckets time, so each row meets its neighbours
by an equi-join and no key's rows are paired with each other outside the window of days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonalith import constants as C


def history(df: DataFrame, key: str, date: str, as_of: Column, days: int = C.TEMPORAL_LOOKBACK_DAYS, most: int = C.HISTORY_ROWS, tie: str | None = None) -> DataFrame:
    """SRC13, WN8: rows of the last `days`, the newest `most` of each key."""
    order = [F.col(date).desc(), *([F.col(tie).desc()] if tie else [])]
    own = df.where(F.col(date) >= F.date_sub(as_of, days))
    return own.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= most)


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """SRC14, WN2, SO3: the newest row of each key, by a partial aggregate."""
    rest = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("best")
    return df.groupBy(key).agg(best).select(key, "best.*")


def trend(df: DataFrame, key: str, date: str, value: str, tie: str, window_days: int = C.TREND_WINDOW_DAYS, digits: int = 5) -> DataFrame:
    """AG10b, WN5: slope per day over the last window (or the last three points), its direction, points, span and change."""
    own = df.where(F.col(value).isNotNull() & F.col(date).isNotNull()).select(key, F.col(date).alias("d"), F.col(value).alias("v"), F.col(tie).alias("t"))
    by = Window.partitionBy(key)
    own = own.withColumn("age", F.date_diff(F.max("d").over(by), "d")).withColumn("back", F.row_number().over(by.orderBy(F.col("d").desc(), F.col("t").desc())))
    own = own.withColumn("near", F.count_if(F.col("age") <= window_days).over(by)).withColumn("all", F.count("*").over(by))
    used = own.where(F.when(F.col("all") < 3, True).when(F.col("near") >= 3, F.col("age") <= window_days).otherwise(F.col("back") <= 3))
    x = -F.col("age").cast("double")
    g = used.groupBy(key).agg(
        F.count("*").alias("n_points"),
        F.max("all").alias("all"),
        F.regr_slope("v", x).alias("slope"),
        (F.max("age") - F.min("age")).alias("span"),
        (F.max_by("v", F.struct("d", "t")) - F.min_by("v", F.struct("d", "t"))).alias("delta"),
    )
    enough = (F.col("all") >= 3) & (F.col("span") > 0)
    word = F.lit("sharp_improving")
    for cut, name in reversed(C.TREND_CUTS):
        below = F.col("slope") <= cut if cut < 0 else F.col("slope") < cut
        word = F.when(below, name).otherwise(word)
    return g.select(
        key,
        F.when(enough, F.round("slope", digits)).alias("slope_per_day"),
        F.when(enough, word).otherwise("insufficient_data").alias("direction"),
        "n_points",
        F.when(F.col("all") >= 3, F.col("span").cast("double")).alias("span_days"),
        F.when(enough, F.round("delta", 4)).alias("delta_total"),
    )


def weighted_regression(df: DataFrame, key: str, x: str, y: str, w: str) -> DataFrame:
    """AG11: intercept, slope and weighted RMSE; NULL where singular."""
    sums = df.groupBy(key).agg(
        F.sum(w).alias("sw"),
        F.sum(F.col(w) * F.col(x)).alias("sx"),
        F.sum(F.col(w) * F.col(y)).alias("sy"),
        F.sum(F.col(w) * F.col(x) * F.col(x)).alias("sxx"),
        F.sum(F.col(w) * F.col(x) * F.col(y)).alias("sxy"),
    )
    den = F.col("sw") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.when((F.col("sw") > 0) & (F.abs(den) >= 1e-12), (F.col("sw") * F.col("sxy") - F.col("sx") * F.col("sy")) / den)
    fit = sums.withColumn("slope", slope).withColumn("intercept", (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("sw")).select(key, "slope", "intercept")
    rest = F.col(y) - (F.col("intercept") + F.col("slope") * F.col(x))
    return df.join(fit, key).groupBy(key).agg(F.max("intercept").alias("intercept"), F.max("slope").alias("slope"), F.sqrt(F.sum(F.col(w) * rest * rest) / F.sum(w)).alias("rmse"))


def forecast(df: DataFrame, key: str, date: str, value: str, quality: str, tie: str, days: int = C.FORECAST_MAX_DAYS) -> DataFrame:
    """FLT11 and section 2.11: up to five bounded days ahead of each eligible series."""
    own = df.select(key, F.col(date).alias("d"), F.col(value).alias("y"), F.col(quality).alias("q0"), F.col(tie).alias("t")).where(f"d is not null and y is not null and q0 >= {C.FORECAST_MIN_QUALITY}")
    own = own.withColumn("q", F.greatest(F.lit(0.05), F.least(F.lit(1.0), F.col("q0"))))
    by = Window.partitionBy(key)
    back = by.orderBy(F.col("d").desc(), F.col("y").desc(), F.col("q").desc(), F.col("t").desc())
    own = own.withColumn("back", F.row_number().over(back)).withColumn("origin", F.min("d").over(by)).withColumn("x", F.date_diff("d", "origin").cast("double"))
    head = own.groupBy(key).agg(
        F.count("*").alias("n"),
        F.max("d").alias("latest"),
        F.min("d").alias("origin"),
        F.max(F.when(F.col("back") == 1, F.col("y"))).alias("latest_y"),
        F.max(F.when(F.col("back") == 2, F.col("d"))).alias("before"),
        (F.max(F.when(F.col("back") <= 4, F.col("y"))) - F.min(F.when(F.col("back") <= 4, F.col("y")))).alias("spread"),
    )
    span = F.date_diff("latest", "origin")
    head = head.where((F.col("n") >= C.FORECAST_MIN_HISTORY) & (span > 0) & (span <= C.FORECAST_MAX_SPAN_DAYS) & (F.date_diff("latest", "before") <= C.FORECAST_MAX_GAP_DAYS))
    fit = weighted_regression(own.where(F.col("back") <= C.FORECAST_MAX_HISTORY), key, "x", "y", "q").where("slope is not null")
    out = head.join(fit, key).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(min(days, C.FORECAST_MAX_DAYS)))))
    slope = F.greatest(F.lit(-0.05), F.least(F.lit(0.05), F.col("slope")))
    base = F.least(F.lit(0.30), F.greatest(F.lit(0.04), F.col("rmse") * 2.0) + F.col("spread") * 0.15)
    line = F.col("intercept") + slope * (F.date_diff("latest", "origin") + F.col("k"))
    clamp = lambda c: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))
    out = out.withColumn("p", clamp(0.7 * line + 0.3 * F.col("latest_y"))).withColumn("u", F.least(F.lit(0.35), base + 0.02 * F.col("k")))
    return out.select(
        key,
        F.date_add("latest", F.col("k")).alias("date"),
        F.round("p", 6).alias("estimated"),
        F.round(clamp(F.col("p") - F.col("u")), 6).alias("low"),
        F.round(clamp(F.col("p") + F.col("u")), 6).alias("high"),
        F.col("k").alias("horizon_days"),
        F.round(slope, 6).alias("slope_per_day"),
        F.least("n", F.lit(C.FORECAST_MAX_HISTORY)).alias("training_count"),
        F.round("rmse", 6).alias("rmse"),
        F.col("latest").alias("latest_date"),
    )


def predicted_records(forecasts: DataFrame, key: str, model: str) -> DataFrame:
    """CD7: forecast rows as predicted, unvalidated records with their own ids."""
    scene = F.concat_ws(":", F.lit("PREDICTED"), F.col(key).cast("string"), F.date_format("date", "yyyy-MM-dd"), F.lit(model))
    return forecasts.withColumn("scene_id", scene).withColumn("observed_or_predicted", F.lit("predicted")).withColumn("validation_status", F.lit("estimated_unvalidated"))


def temporal_outliers(rows: DataFrame, points: DataFrame, key: str, date: str, value: str, days: int = C.TEMPORAL_WINDOW_DAYS, most: float = C.TEMPORAL_MAX_DELTA) -> DataFrame:
    """JN10, SM6: each row with the point within `days` (not the same day) that differs most, when by more than `most`."""
    bucket = lambda d: F.floor(F.unix_date(d) / days)
    p = points.where(F.col(value).isNotNull() & F.col(date).isNotNull()).select(F.col(key).alias("pk"), F.col(date).alias("pd"), F.col(value).alias("pv")).distinct()
    p = p.withColumn("pb", F.explode(F.array(*[bucket("pd") + k for k in (-1, 0, 1)])))
    r = rows.select(key, F.col(date), F.col(value)).where(F.col(value).isNotNull()).distinct().withColumn("b", bucket(date))
    gap = F.abs(F.date_diff(date, "pd"))
    delta = F.abs(F.col("pv") - F.col(value))
    hit = r.join(p, (F.col(key) == F.col("pk")) & (F.col("b") == F.col("pb"))).where((gap > 0) & (gap <= days) & (delta > most))
    worst = hit.groupBy(key, date, value).agg(F.max(delta).alias("abs_delta"), F.max_by("pd", F.struct(delta, -F.unix_date("pd"))).alias("ref_date"))
    out = rows.join(worst, [key, date, value], "left")
    return out.withColumn("temporal_outlier", F.col("abs_delta").isNotNull())


def as_of_previous(df: DataFrame, key: str, order: list[str], value: str, out: str) -> DataFrame:
    """JN11, WN9: the last value before this row that is not null."""
    before = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(before))


def trend_series(new: DataFrame, old: DataFrame, scene: str) -> DataFrame:
    """JN12: new rows and those of the history whose scene is not new."""
    return new.unionByName(old.join(new.select(scene), scene, "left_anti"), allowMissingColumns=True)


def gaps(df: DataFrame, key: str, date: str, tie: str) -> DataFrame:
    """WN7: days since the previous row."""
    return df.withColumn("gap_days", F.date_diff(date, F.lag(date).over(Window.partitionBy(key).orderBy(date, tie))))
