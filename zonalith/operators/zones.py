"""Field quarters: where to look first (section 2.10)."""

from __future__ import annotations

import operator

from pyspark.sql import DataFrame, Window, functions as F

from zonalith import constants as C
from zonalith.operators import stats


def quarters(cells: DataFrame, key: str, row: str, col: str, weight: str, coverage: str, values: dict[str, str]) -> DataFrame:
    """AG16-AG17: one row for each field and quarter: interior cells, weight and weighted means (NULL with fewer than two
    interior cells). Rows below the weighted centre row are north, columns from the centre on are east. Sides are told by exact
    sums, weights to 12 places: cells right at the centre do not change sides with the order of the rows. Fields with a weight of
    a million or a place of a thousand million or more, either sign, have float sums."""
    by = Window.partitionBy(key)
    w = F.col(weight)
    first = next(iter(values.values()))
    r, c, k = F.col(row).try_cast("decimal(9,0)"), F.col(col).try_cast("decimal(9,0)"), w.try_cast(stats.EXACT)
    lost = lambda x, own: x.isNull() & own.isNotNull()
    sums = {"sr": r * k, "sc": c * k, "sw": k, "fr": F.col(row) * w, "fc": F.col(col) * w, "fw": w}
    own = cells.withColumns({n: F.sum(x).over(by) for n, x in sums.items()} | {"fits": ~F.max(lost(r, F.col(row)) | lost(c, F.col(col)) | lost(k, w)).over(by)})
    sw, fw = F.col("sw"), F.col("fw")

    def side(is_on, place, x, s, f):
        """Whether a place is on that side of s / sw: a negative sw turns the comparison round, with 0 the centre is infinitely far."""
        far = lambda total: is_on(F.lit(0), F.when(F.col(total) < 0, -1).otherwise(1))
        exact = F.when(sw > 0, is_on(x * sw, F.col(s))).when(sw < 0, is_on(F.col(s), x * sw)).otherwise(far(s))
        floats = F.when(fw != 0, is_on(place, F.try_divide(f, fw))).otherwise(far(f))
        return F.when(place.isNotNull(), F.when(F.col("fits"), exact).otherwise(floats))

    north, east = side(operator.lt, F.col(row), r, "sr", "fr"), side(operator.ge, F.col(col), c, "sc", "fc")
    quarter = F.concat(F.when(north, "N").otherwise("S"), F.when(east, "E").otherwise("W"))
    interior = (F.col(coverage) >= C.INTERIOR_COVERAGE) & (w > 0) & F.col(first).isNotNull()
    mean = lambda c: F.try_divide(F.sum(F.when(F.col(c).isNotNull() & (w > 0), F.col(c) * w)), F.sum(F.when(F.col(c).isNotNull() & (w > 0), w)))
    out = own.where("fw is not null").groupBy(key, quarter.alias("quarter")).agg(F.count_if(interior).alias("interior_cells"), F.round(F.sum(w), 3).alias("epc"), *[mean(c).alias(n) for n, c in values.items()])
    enough = F.col("interior_cells") >= C.ZONE_MIN_QUARTER
    return out.select(key, "quarter", "interior_cells", "epc", *[F.when(enough, F.col(n)).alias(n) for n in values])


def assess(quarter_rows: DataFrame, fields: DataFrame, key: str) -> DataFrame:
    """Levels of growth and water for each field. fields: key, median, se, evidence, prev_weakest, prev_level, prev_water_weakest,
    prev_water_level. quarter_rows: of quarters(), with ndvi, ndre, ndmi."""
    order = F.expr("array_position(array('NE','NW','SE','SW'), quarter)")
    has = lambda c: F.col("ndvi").isNotNull() & F.col(c).isNotNull()
    weakest = lambda c: F.min_by("quarter", F.when(has(c), F.struct(F.col(c), order)))
    g = quarter_rows.groupBy(key).agg(
        F.sum("interior_cells").alias("n_interior"),
        F.sum("epc").alias("weight"),
        F.count("ndvi").alias("judged"),
        weakest("ndvi").alias("low_ndvi"),
        F.min("ndvi").alias("min_ndvi"),
        F.count_if(has("ndmi")).alias("n_ndmi"),
        weakest("ndmi").alias("low_ndmi"),
        F.min(F.when(has("ndmi"), F.col("ndmi"))).alias("min_ndmi"),
        F.median(F.when(has("ndmi"), F.col("ndmi"))).alias("med_ndmi"),
        F.count_if(has("ndre")).alias("n_ndre"),
        weakest("ndre").alias("low_ndre"),
    )
    j = fields.join(g, key, "left")
    early = (
        F.when(F.col("n_interior").isNull(), "no_ndvi")
        .when(F.col("n_interior") < C.ZONE_MIN_INTERIOR, "field_too_small")
        .when(~F.coalesce(F.lower("evidence").isin("high", "medium"), F.lit(False)), "evidence_below_medium")
        .when(F.col("weight") <= 0, "no_crop_weight")
    )
    j = j.withColumn("early", early).withColumn("delta", F.col("median") - F.col("min_ndvi")).withColumn("w_delta", F.col("med_ndmi") - F.col("min_ndmi"))
    live = F.col("early").isNull()
    seen = lambda level, q, now: F.coalesce(F.col(level).isin("watch", "check") & (F.col(q) == F.col(now)), F.lit(False))
    w_real = live & (F.col("n_ndmi") >= 2) & (F.col("w_delta") >= C.ZONE_MIN_DELTA)
    w_again = seen("prev_water_level", "prev_water_weakest", "low_ndmi")
    few = (F.col("judged") < 2) | F.col("median").isNull()
    se = F.when(F.col("se") != 0, F.col("se"))
    gap = (F.col("delta") >= C.ZONE_MIN_DELTA) & (se.isNull() | (F.col("delta") >= C.ZONE_SE_MULTIPLE * se))
    real = live & ~few & gap
    again = seen("prev_level", "prev_weakest", "low_ndvi")
    ndmi = F.coalesce((F.col("n_ndmi") >= 2) & (F.col("low_ndmi") == F.col("low_ndvi")), F.lit(False))
    ndre = F.coalesce((F.col("n_ndre") >= 2) & (F.col("low_ndre") == F.col("low_ndvi")), F.lit(False))
    pattern = F.when(ndmi & ~ndre, "moisture_led").when(ndre & ~ndmi, "greenness_led").when(ndmi & ndre, "all_indices").otherwise("vigour_only")
    return j.select(
        key,
        F.when(w_real, F.col("low_ndmi")).alias("water_weakest"),
        F.when(w_real, F.when(w_again, "check").otherwise("watch")).otherwise("none").alias("water_level"),
        F.when(live & (F.col("n_ndmi") >= 2), F.round("w_delta", 4)).alias("water_delta"),
        F.when(live & ~few, F.col("low_ndvi")).alias("weakest"),
        F.when(live & ~few, F.round("delta", 4)).alias("delta"),
        F.when(real, F.when(again, "check").otherwise("watch")).otherwise("none").alias("level"),
        F.coalesce("early", F.when(few, "too_few_judged_quarters").when(~gap, "gap_within_noise").when(again, "gap_persists_two_passes").otherwise("gap_one_pass")).alias("reason"),
        F.when(real, pattern).alias("pattern"),
    )
