"""LMS z-score: edge ages with real grid rows, properties, bad values."""

import math

import pytest
from pyspark.sql import functions as F

from anthro.functions.lms import is_valid_z, lms_zscore, strict_z_filter
from anthro.operators.zscore import lms_interpolate, with_zscore
from anthro.sources.grids import grid_from_rows

# --- fixed values: nine rows of the male BMI-for-age grid the original job
# reads (age in months, L, M, S), enough to bracket the edge ages below ---
MALE_ROWS = [
    (24.0, -2.01118107, 16.57502768, 0.080592465),
    (24.5, -1.982373595, 16.54777487, 0.080127429),
    (25.5, -1.924100169, 16.49442763, 0.079233994),
    (29.5, -1.69481584, 16.29584097, 0.076148308),
    (30.5, -1.642106779, 16.24972371, 0.075499126),
    (31.5, -1.592744414, 16.20495268, 0.074898994),
    (239.5, -1.841146139, 22.99908062, 0.134408381),
    (240.0, -1.84233016, 23.02029424, 0.134539365),
    (240.5, -1.843580575, 23.04137734, 0.134675001),
]
# --- end of fixed values ---


def _grid(spark):
    return grid_from_rows(spark, [("male", *r) for r in MALE_ROWS])


def _ages(spark, ages, bmi=17.0):
    rows = [(i, float(a), "male", bmi) for i, a in enumerate(ages)]
    return spark.createDataFrame(rows, "id long, age_in_months double, gender string, bmi_value double")


EDGE = [23.9, 24.0, 24.2, 30.5, 240.4, 240.5, 240.6]


def test_edge_ages_rank1(spark):
    out = with_zscore(lms_interpolate(_ages(spark, EDGE), _grid(spark), k=1))
    got = {r["age_in_months"]: (r["lower_age"], r["upper_age"], r["z_score"])
           for r in out.collect()}
    expect = {24.0: (24.0, 24.0, 0.3063), 24.2: (24.0, 24.5, 0.3148), 30.5: (30.5, 30.5, 0.5762),
              240.4: (240.0, 240.5, -3.0257), 240.5: (240.5, 240.5, -3.0276)}
    assert set(got) == set(expect)          # 23.9 and 240.6 fall outside
    for a, (lo, hi, z) in expect.items():
        assert got[a][:2] == (lo, hi)
        assert got[a][2] == pytest.approx(z, abs=1e-4)


def test_edge_ages_rank2(spark):
    out = with_zscore(lms_interpolate(_ages(spark, EDGE), _grid(spark), k=2))
    rows = out.collect()
    assert [(r["age_in_months"], r["lower_age"], r["upper_age"]) for r in rows] == [(30.5, 29.5, 31.5)]
    assert rows[0]["z_score"] == pytest.approx(0.5755, abs=1e-4)


def test_grid_points_return_own_parameters(spark):
    out = lms_interpolate(_ages(spark, [r[0] for r in MALE_ROWS]), _grid(spark), k=1)
    got = {r["age_in_months"]: (r["l"], r["m"], r["s"]) for r in out.collect()}
    for a, l, m, s in MALE_ROWS:
        assert got[a] == (l, m, s)


def _z(spark, rows, strict=False):
    df = spark.createDataFrame(rows, "id long, x double, l double, m double, s double")
    z = lms_zscore("x", "l", "m", "s", zero_guard=not strict)
    out = df.withColumn("z", z)
    keep = strict_z_filter("x", "m", "s", "z") if strict else is_valid_z("z")
    return {r["id"]: r["z"] for r in out.filter(keep).collect()}, {r["id"]: r["z"] for r in out.collect()}


def test_properties(spark):
    rows = [(0, 16.0, -1.5, 16.0, 0.08),          # x = M -> 0
            (1, 15.0, -1.5, 16.0, 0.08), (2, 17.0, -1.5, 16.0, 0.08),
            (3, 17.0, 1e-9, 16.0, 0.08),          # L near 0 ...
            (4, 17.0, 0.0, 16.0, 0.08)]           # ... approaches the log form
    kept, _ = _z(spark, rows)
    assert kept[0] == 0.0
    assert kept[1] < kept[0] < kept[2]
    assert kept[4] == pytest.approx(math.log(17 / 16) / 0.08)
    assert kept[3] == pytest.approx(kept[4], rel=1e-6)


def test_bad_values(spark):
    rows = [(0, 0.0, -1.5, 16.0, 0.08),       # 0 ** negative: guarded -> NULL
            (1, -17.0, -1.5, 16.0, 0.08),     # negative ** fraction: NaN
            (2, None, -1.5, 16.0, 0.08),      # NULL value
            (3, float("nan"), -1.5, 16.0, 0.08),
            (4, 17.0, -1.5, 0.0, 0.08),       # M = 0
            (5, 17.0, -1.5, 16.0, 0.0),       # S = 0
            (6, 0.0, 0.0, 16.0, 0.08),        # ln(0)
            (7, 0.0, 1.5, 16.0, 0.08),        # 0 ** positive: a real z
            (8, 17.0, 0.0, 16.0, 0.08)]       # L = 0: log form
    kept, raw = _z(spark, rows)
    assert sorted(kept) == [7, 8]
    assert raw[0] is None and math.isnan(raw[1])
    assert kept[7] == pytest.approx(-1 / (1.5 * 0.08))
    strict, _ = _z(spark, rows, strict=True)
    assert sorted(strict) == [8]            # strict also needs value > 0


def test_strict_without_guard_keeps_finite_only(spark):
    # 0 ** -1.5 is +Infinity in Spark; strict drops it by the value > 0 rule
    # and by |z| <= 1e15.
    kept, raw = _z(spark, [(0, 0.0, -1.5, 16.0, 0.08)], strict=True)
    assert kept == {} and math.isinf(raw[0])


def test_is_valid_z_is_one_comparison(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "z double")
    assert [r["z"] for r in df.filter(is_valid_z(F.col("z"))).collect()] == [1.0]
