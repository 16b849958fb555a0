"""Closed-form values of the measurement contract."""

import math

import pytest
from pyspark.sql import functions as F

from zonalith.functions import evidence as E, geo, spectral as S


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(cols)]).first()


def test_calibration(spark):
    n = F.lit(None).cast("string")
    cal = S.scale_offset(F.lit("0.0001"), F.lit("-0.1"), n)
    late, early = S.scale_offset(n, n, F.lit("05.12")), S.scale_offset(n, n, F.lit("03.01"))
    r = lambda dn, c: S.reflectance(F.lit(dn), c["scale"], c["offset"])
    row = one(spark, r(3000, cal), r(7000, cal), r(1000, cal), r(900, cal), r(3000, late), r(3000, early), late["source"], early["source"])
    assert [row[0], row[1], row[4], row[5]] == pytest.approx([0.2, 0.6, 0.2, 0.3], abs=1e-6)
    # The zero of the offset is below zero in single precision.
    assert row[2] is None and row[3] is None
    assert (row[6], row[7]) == ("esa_boa_add_offset_fallback", "sentinel2_default")
    assert one(spark, S.nd(F.lit(0.6), F.lit(0.2)))[0] == pytest.approx(0.5)
    with pytest.raises(Exception, match="invalid reflectance scale"):
        one(spark, S.scale_offset(F.lit("-1"), n, n)["scale"])


def test_missing_is_null(spark):
    row = one(spark, S.nd(F.lit(0.0), F.lit(0.0)), S.nd(F.lit(None).cast("double"), F.lit(1.0)), S.finite(F.lit(float("nan"))), S.finite(F.lit(float("inf"))), S.safe_round(F.lit("x"), 2), S.safe_round(F.lit("1.237"), 2), S.mcari(F.lit(0.2), F.lit(0.01), F.lit(0.1)))
    assert list(row) == [None, None, None, None, None, 1.24, None]


def test_index_driver_skips_missing_bands():
    b = {"b08": F.lit(0.5), "b04": F.lit(0.1), "b11": F.lit(0.2)}
    assert set(S.indices(b)) == {"NDVI", "SAVI", "NDMI"}


def test_radar(spark):
    r = S.radar(F.lit(0.10), F.lit(0.05))
    row = one(spark, r["rvi"], S.radar(F.lit(0.0), F.lit(0.05))["rvi"], S.radar(F.lit(1e-9), F.lit(5.0))["rvi"])
    assert row[0] == pytest.approx(4 * 0.05 / 0.15, rel=1e-4) and row[1] is None and row[2] == 2.0


@pytest.mark.parametrize(
    ("epc", "purity", "level"),
    [(8.34, 0.48, "medium"), (8.34, 0.97, "high"), (3.5, 0.50, "low"), (2.0, 0.99, "insufficient"), (9.0, None, "high"), (2.0, 0.1, "low"), (None, 0.9, "low")],
)
def test_evidence_tier(spark, epc, purity, level):
    c = lambda v: F.lit(v).cast("double")
    assert one(spark, E.evidence_tier(c(epc), c(purity))["confidence"])[0] == level


def test_clean_pixel_tier(spark):
    row = one(spark, *[E.clean_pixel_tier(F.lit(v).cast("double"))["tier"] for v in (10.0, 9.99, 3.0, 2.9, None)])
    assert list(row) == ["real", "indicative", "indicative", "too_small", "too_small"]


def assessed(spark, **kw):
    base = dict(epc_valid=40.0, epc_total=40.0, valid_px=44, field_px=44, cloud=0.0, shadow=0.0, snow=0.0, purity=0.9, interior_epc=30.0, buffered=True, acres=1.0, geometry="high") | kw
    kind = {"valid_px": "long", "field_px": "long", "buffered": "boolean", "geometry": "string"}
    return one(spark, E.assess(**{k: F.lit(v).cast(kind.get(k, "double")) for k, v in base.items()}))[0]


def test_assess(spark):
    a = assessed(spark)
    assert a.quality == 0.96 and a.level == "high" and a.reject_reason is None
    # Never above the stored single-precision quality.
    import numpy as np

    assert a.confidence <= float(np.float32(a.quality))
    assert assessed(spark, cloud=0.4).reject_reason == "field cloud 40% > 30%"
    assert assessed(spark, epc_valid=10.0).reject_reason == "valid_fraction 0.25 < 0.5"
    assert assessed(spark, interior_epc=4.0).confidence <= 0.54
    assert assessed(spark, interior_epc=None, purity=0.5).confidence <= 0.74
    assert assessed(spark, geometry="guess").confidence < 0.5
    assert assessed(spark, interior_epc=1.0).confidence <= 0.30


def test_context_delta(spark):
    d = lambda tier: E.context_delta(F.lit(0.55), F.lit(0.60), F.lit(0.001), F.lit(25), F.lit(0.02), F.lit(tier))
    row = one(spark, d("real")["z"], d("indicative")["z"], d("indicative")["delta"])
    assert abs(row[0]) < 3 and row[1] is None and row[2] == pytest.approx(-0.05)


def test_iso_week(spark):
    row = one(spark, E.cohort_key(F.lit(" Rice "), F.lit("2027-01-01").cast("date"), F.lit("b1")), E.cohort_key(F.lit("rice"), F.lit(None).cast("date"), F.lit("b1")))
    assert list(row) == ["rice:2026-W53:b1", None]


def test_utm(spark):
    e, n = geo.utm(F.lit(0.0), F.lit(3.0))
    e2, n2 = geo.utm(F.lit(-45.0), F.lit(6.0))
    row = one(spark, e, n, e2, n2, geo.spatial_group_key(F.lit(17.2), F.lit(74.05)), geo.spatial_group_key(F.lit(89.0), F.lit(74.05)))
    assert row[0] == pytest.approx(500000.0, abs=1e-6) and row[1] == pytest.approx(0.0, abs=1e-6)
    # 45 degrees south at the western edge of zone 32.
    assert 263000 < row[2] < 264000 and 5012600 < row[3] < 5012700
    assert row[4].startswith("utm43N:") and row[5] is None


def test_colour_and_paths(spark):
    c = geo.ramp_color(F.lit(2.0))
    row = one(spark, c["r"], c["g"], c["b"], geo.image_path(F.lit("t"), F.lit("l"), F.lit("2026-01-02").cast("date"), F.lit("S2/é.x"), "_zones"), geo.fingerprint(F.expr("array(array(named_struct('x', 1D, 'y', 2D)))")))
    assert (row[0], row[1], row[2]) == (0x1B, 0x5E, 0x20) and row[3] == "t/l/2026-01-02_S2_é_x_zones.png" and len(row[4]) == 16
    assert math.isclose(one(spark, S.bounds_95(F.lit(0.5), F.lit(0.1))["low"])[0], 0.304)
