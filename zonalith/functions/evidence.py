"""Tiers, quality and confidence, gates and decision evidence as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from zonalith import constants as C


def clean_pixel_tier(interior_epc: Column) -> Column:
    """PRJ27: struct(status, confidence, tier) from whole interior pixels."""
    n = F.coalesce(interior_epc, F.lit(0.0))
    pick = lambda a, b, c: F.when(n >= C.CLEAN_PX_REAL, a).when(n >= C.CLEAN_PX_MIN, b).otherwise(c)
    return F.struct(
        pick("OBSERVED_STRONG", "OBSERVED_WEAK", "INSUFFICIENT_SPATIAL_SUPPORT").alias("status"),
        pick("high", "low", "insufficient").alias("confidence"),
        pick("real", "indicative", "too_small").alias("tier"),
    )


def evidence_tier(epc: Column, purity: Column) -> Column:
    """PRJ28: struct(status, confidence); low purity demotes by one band, never into the last."""
    band = F.when(epc >= C.EPC_STRONG, 0).when(epc >= C.EPC_LIMITED, 1).when(epc >= C.EPC_WEAK, 2).otherwise(3)
    # A band of 3 with low purity is set to 2, as least(band + 1, 2).
    band = F.when(purity < C.LOW_PURITY, F.least(band + 1, F.lit(2))).otherwise(band)
    status = F.element_at(F.array(*[F.lit(s) for s, _ in C.TIERS]), band + 1)
    level = F.element_at(F.array(*[F.lit(c) for _, c in C.TIERS]), band + 1)
    return F.struct(
        F.when(epc.isNull(), "UNKNOWN_SPATIAL_SUPPORT").otherwise(status).alias("status"),
        F.when(epc.isNull(), "low").otherwise(level).alias("confidence"),
    )


def percent(x: Column) -> Column:
    """A fraction as a whole percentage, half to even."""
    return F.concat(F.bround(x * 100, 0).cast("int").cast("string"), F.lit("%"))


def field_gate(cloud: Column, shadow: Column, snow: Column, epc_valid: Column, valid_px: Column, valid_fraction: Column, quality: Column) -> Column:
    """FLT5: the first reason to reject, or NULL."""
    two = lambda x: F.format_string("%.2f", x)
    return (
        F.when(cloud > C.MAX_FIELD_CLOUD, F.concat(F.lit("field cloud "), percent(cloud), F.lit(" > 30%")))
        .when(shadow > C.MAX_FIELD_SHADOW, F.concat(F.lit("field shadow "), percent(shadow), F.lit(" > 20%")))
        .when(snow > C.MAX_FIELD_SNOW, F.concat(F.lit("field snow/bright-cloud "), percent(snow), F.lit(" > 10%")))
        .when((F.coalesce(epc_valid, F.lit(0.0)) == 0) & (valid_px < C.MIN_VALID_PIXELS), F.concat(F.lit("valid_pixels "), valid_px.cast("string"), F.lit(" < 8")))
        .when(valid_fraction < C.MIN_VALID_FRACTION, F.concat(F.lit("valid_fraction "), two(valid_fraction), F.lit(" < 0.5")))
        .when(quality < C.MIN_QUALITY, F.concat(F.lit("quality_score "), two(quality), F.lit(" < 0.35")))
    )


def assess(*, epc_valid: Column, epc_total: Column, valid_px: Column, field_px: Column, cloud: Column, shadow: Column, snow: Column, purity: Column, interior_epc: Column, buffered: Column, acres: Column, geometry: Column) -> Column:
    """PRJ29, section 2.9: struct(quality, confidence, level, status, evidence, reject_reason, valid_fraction), in the contract's order."""
    fraction = F.when(epc_total > 0, epc_valid / epc_total).otherwise(F.when(field_px > 0, valid_px / field_px).otherwise(0.0))
    coverage = F.least(fraction / C.MIN_VALID_FRACTION, F.lit(1.0))
    support = F.when(epc_valid > 0, F.least(epc_valid / C.EPC_SATURATION, F.lit(1.0))).otherwise(0.0)
    clear = F.greatest(F.lit(0.0), 1.0 - (cloud + shadow))
    score = C.QW_COVERAGE * coverage + C.QW_SUPPORT * support + C.QW_CLEAR * clear
    score = score * F.when(buffered, 1.0).otherwise(C.UNBUFFERED_FACTOR)
    quality = F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 3)
    micro = F.coalesce(acres < C.MICRO_LAND_ACRES, F.lit(False))
    score = score * F.when(purity < C.LOW_PURITY, C.LOW_PURITY_FACTOR).when(purity.isNull() & micro, C.MICRO_LAND_FACTOR).otherwise(1.0)
    score = score * F.when(geometry == "high", 1.0).when(geometry == "medium", 0.85).when(geometry == "low", 0.55).otherwise(0.5)
    clean, tier = clean_pixel_tier(interior_epc), evidence_tier(F.when(epc_valid != 0, epc_valid), purity)
    status = F.when(interior_epc.isNotNull(), clean["status"]).otherwise(tier["status"])
    level = F.when(interior_epc.isNotNull(), clean["confidence"]).otherwise(tier["confidence"])
    score = F.least(score, F.when(level == "medium", 0.74).when(level == "low", 0.54).when(level == "insufficient", 0.30).otherwise(9.0))
    stored = quality.cast("float").cast("double")
    confidence = F.floor((F.least(F.greatest(score, F.lit(0.0)), stored) - 1e-6) * 1e6) / 1e6
    confidence = F.greatest(confidence, F.lit(0.0))
    reject = field_gate(cloud, shadow, snow, epc_valid, valid_px, fraction, quality)
    word = F.when(reject.isNotNull(), "rejected").when(confidence >= 0.75, "high").when(confidence >= 0.55, "medium").otherwise("low")
    return F.struct(
        quality.alias("quality"),
        confidence.alias("confidence"),
        word.alias("level"),
        F.when(reject.isNotNull(), "rejected").otherwise(status).alias("status"),
        F.when(reject.isNotNull(), "rejected").otherwise(level).alias("evidence"),
        reject.alias("reject_reason"),
        F.round(fraction, 4).alias("valid_fraction"),
    )


def radar_quality(epc: Column, acres: Column, geometry: Column, evidence: Column) -> Column:
    """PRJ30: struct(quality, confidence, level); confidence stays below the stored quality."""
    raw = 0.5 * F.least(epc / C.EPC_SATURATION, F.lit(1.0))
    quality = F.round(raw, 3)
    c = raw * 0.70 * F.when(acres < C.MICRO_LAND_ACRES, C.MICRO_LAND_FACTOR).otherwise(1.0)
    c = c * F.when(geometry == "high", 1.0).when(geometry == "medium", 0.85).when(geometry == "low", 0.55).otherwise(0.5)
    c = c * F.when(evidence.isin("low", "insufficient"), 0.75).otherwise(1.0)
    confidence = F.greatest(F.round(F.least(c, quality - 1e-3), 3), F.lit(0.0))
    level = F.when(confidence >= 0.40, "high").when(confidence >= 0.25, "medium").otherwise("low")
    return F.struct(quality.alias("quality"), confidence.alias("confidence"), level.alias("level"))


def radar_gate(epc: Column, valid_px: Column) -> Column:
    """FLT6: the first reason to reject a radar row, or NULL."""
    few = F.concat(F.lit("valid_pixels "), valid_px.cast("string"), F.lit(" < 8"))
    return F.when(epc < C.MIN_EPC, F.concat(F.lit("EPC "), F.format_string("%.2f", epc), F.lit(" < 3.0"))).when(valid_px < C.MIN_VALID_PIXELS, few)


def cohort_key(crop: Column, day: Column, block: Column) -> Column:
    """PRJ21: crop, ISO week and block; NULL when any is missing."""
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))
    missing = crop.isNull() | (crop == "") | day.isNull() | block.isNull() | (block == "")
    return F.when(~missing, F.concat_ws(":", F.lower(F.trim(crop)), week, block))


def context_population(cohort_size: Column, least: Column, ring: Column) -> Column:
    """PRJ22."""
    return F.when(cohort_size >= least, "stage_cohort").when(ring, "spatial_ring_fallback").otherwise("none")


def temporal_support(days: Column, limit: Column) -> Column:
    """PRJ23."""
    return F.when(limit > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - days / limit)))


def uncertainty_vector(measurement: Column, spatial: Column, temporal: Column, agreement: Column, model: Column) -> Column:
    """PRJ24: the five parts and the least of those known."""
    parts = {"measurement_quality": measurement, "spatial_support": spatial, "temporal_support": temporal, "agreement": agreement, "model_confidence": model}
    return F.struct(*[c.alias(n) for n, c in parts.items()], F.least(*parts.values()).alias("minimum_gate"))


def water_stress(*core: Column) -> Column:
    """PRJ25: struct(count, status); corroborated only when all four are true."""
    count = sum((F.when(c, 1).otherwise(0) for c in core[1:]), F.when(core[0], 1).otherwise(0))
    return F.struct(count.alias("count"), F.when(count == 4, "corroborated").otherwise("insufficient_evidence").alias("status"))


def zone_gate(cells: Column, least_cells: Column, kappa: Column, least_kappa: Column, cases: Column, least_cases: Column) -> Column:
    """PRJ26."""
    return (cells >= least_cells) & F.coalesce(kappa >= least_kappa, F.lit(False)) & (cases >= least_cases)


def context_delta(parcel: Column, median: Column, mad: Column, n: Column, se: Column, tier: Column) -> Column:
    """PRJ32: struct(delta, z, denominator); a z only for a real ring."""
    sigma = 1.4826 * mad
    ring = F.when(n > 0, 1.2533 * sigma / F.sqrt(n)).otherwise(0.0)
    den = F.sqrt(sigma * sigma + F.coalesce(se, F.lit(0.0)) * F.coalesce(se, F.lit(0.0)) + ring * ring)
    delta = parcel - median
    real = F.coalesce(tier, F.lit("real")) == "real"
    return F.struct(delta.alias("delta"), F.when(real & (den > 1e-9), delta / den).alias("z"), F.when(real, F.round(den, 6)).alias("denominator"))


def error_class(message: Column) -> Column:
    """PRJ38: rate_limited, server_or_timeout or other."""
    m = F.lower(F.coalesce(message, F.lit("")))
    return F.when(m.rlike("429|too many requests|throttl|rate limit"), "rate_limited").when(m.rlike("500|502|503|504|timeout|timed out"), "server_or_timeout").otherwise("other")


#: Parts of messages after which a write is worth trying again.
TRANSIENT = (
    "server disconnected",
    "connection reset",
    "connection aborted",
    "remoteprotocolerror",
    "timeout",
    "temporarily unavailable",
    "connection error",
    "read timeout",
    "502",
    "503",
    "504",
)


def transient(message: Column) -> Column:
    """Whether a write is worth trying again."""
    return F.lower(F.coalesce(message, F.lit(""))).rlike("|".join(TRANSIENT))
