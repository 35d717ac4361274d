"""Bracket lookup equals the plain two-range-join form (brute force)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from anthro.operators.bracket import bracket_lookup, build_brackets
from anthro.operators.day_table import build_day_table, day_lookup
from anthro.sources.grids import GridError, grid_from_rows, validate_grid

from conftest import SF0001


def brute(grid_rows, xs, k, how, sides):
    """The original plan, row by row: k-th nearest at or below / above."""
    out = {}
    for i, g, x in xs:
        ages = sorted(a for gg, a, *_ in grid_rows if gg == g)
        byage = {a: (l, m, s) for gg, a, l, m, s in grid_rows if gg == g}
        ok = x is not None and not (isinstance(x, float) and math.isnan(x))
        lows = [a for a in ages if ok and a <= x][::-1]
        highs = [a for a in ages if ok and a >= x]
        lo = lows[k - 1] if len(lows) >= k else None
        hi = highs[k - 1] if len(highs) >= k else None
        need = {"both": (lo, hi), "lower": (lo,), "upper": (hi,)}[sides]
        if how == "inner" and any(v is None for v in need):
            continue
        rec = {}
        if sides in ("both", "lower"):
            rec["lower_age"] = lo
            rec["l_lo"] = byage[lo][0] if lo is not None else None
        if sides in ("both", "upper"):
            rec["upper_age"] = hi
            rec["l_hi"] = byage[hi][0] if hi is not None else None
        out[i] = rec
    return out


def _key(rows):
    """Rows as sortable tuples with NaN made comparable."""
    return sorted(tuple("nan" if isinstance(v, float) and v != v else v for v in r) for r in rows)


def random_grid(rnd, groups=("a", "b", "c")):
    rows = []
    for g in groups:
        n = rnd.randint(1, 12)
        ages = sorted(rnd.sample(range(0, 400), n))
        ages = [a / 4.0 for a in ages]
        rows += [(g, a, rnd.uniform(-3, 1), rnd.uniform(10, 30), rnd.uniform(0.05, 0.2)) for a in ages]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def xs(spark):
    # Values from the driver tables (prices scaled into the grid range) plus
    # exact grid points, ends, NULL, NaN and a group absent from the grid.
    prices = [r[0] for r in spark.read.parquet(f"{SF0001}/orders.parquet")
              .select((F.col("o_totalprice") / 3000.0).alias("x")).limit(150).collect()]
    vals = prices + [k / 4.0 for k in range(0, 400, 7)] + [-5.0, 0.0, 99.75, 100.0, 500.0]
    groups = ["a", "b", "c", "zz"]
    rows = [(i, groups[i % 4], float(v)) for i, v in enumerate(vals)]
    rows += [(len(rows), "a", None), (len(rows) + 1, "b", float("nan"))]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("k", [1, 2, 3])
def test_equals_brute_force(spark, xs, seed, k):
    rnd = random.Random(seed * 10 + k)
    grid_rows = random_grid(rnd)
    grid = grid_from_rows(spark, grid_rows)
    df = spark.createDataFrame(xs, "id long, gender string, x double")
    for width in (None, 3.0):
        br = build_brackets(grid, k=k, width=width)
        for how in ("inner", "left"):
            for sides in ("both", "lower", "upper"):
                got = {r["id"]: {c: r[c] for c in r.asDict() if c in ("lower_age", "upper_age", "l_lo", "l_hi")}
                       for r in bracket_lookup(df, br, axis="x", how=how, sides=sides).collect()}
                assert got == brute(grid_rows, xs, k, how, sides), (width, how, sides)


@pytest.mark.parametrize("k,how", [(1, "left"), (2, "inner"), (3, "left")])
def test_salted_path_equals_broadcast(spark, xs, k, how):
    grid = grid_from_rows(spark, random_grid(random.Random(7)))
    df = spark.createDataFrame(xs, "id long, gender string, x double")
    a = bracket_lookup(df, build_brackets(grid, k=k), axis="x", how=how)
    br = build_brackets(grid, k=k, max_broadcast_rows=0, salt=5)
    assert not br.broadcast and br.salt == 5
    b = bracket_lookup(df, br, axis="x", how=how)
    assert _key(a.collect()) == _key(b.collect())


def test_argument_checks(spark):
    grid = grid_from_rows(spark, [("male", 1.0, 1, 1, 1), ("male", 2.0, 1, 1, 1)])
    with pytest.raises(ValueError):
        build_brackets(grid, k=0)
    with pytest.raises(ValueError):
        build_brackets(grid, width=-1.0)
    df = spark.createDataFrame([(1, "male", 1.5)], "id long, gender string, x double")
    br = build_brackets(grid)
    with pytest.raises(ValueError):
        bracket_lookup(df, br, axis="x", how="right")
    with pytest.raises(ValueError):
        bracket_lookup(df, br, axis="x", sides="middle")


def test_size_bound_holds(spark):
    grid = grid_from_rows(spark, random_grid(random.Random(11)))
    for width in (None, 0.5, 7.0):
        br = build_brackets(grid, k=2, width=width)
        assert br.df.count() <= br.max_rows


def test_day_table_equals_per_row_interpolation(spark):
    rnd = random.Random(5)
    rows = [(g, a / 2.0, rnd.uniform(-2, 1), rnd.uniform(12, 25), rnd.uniform(0.05, 0.15))
            for g in ("male", "female") for a in range(40, 90)]
    grid = grid_from_rows(spark, rows)
    days = spark.range(0, 1500).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, "male").otherwise("female").alias("gender"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("birth_datetime"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp_ntz")
        .alias("measurement_datetime"))
    days = days.withColumn("age", F.datediff("measurement_datetime", "birth_datetime") / 30.44)
    for k in (1, 2):
        table = build_day_table(grid, k=k)
        a = day_lookup(days, table, "measurement_datetime", "birth_datetime")
        from anthro.operators.bracket import interpolate
        br = build_brackets(grid, k=k)
        b = interpolate(bracket_lookup(days, br, axis="age"), "age")
        cols = ["id", "lower_age", "upper_age", "l", "m", "s"]
        assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
        assert table.df.count() <= table.max_rows


def test_grid_validation(spark):
    with pytest.raises(GridError, match="duplicate"):
        validate_grid(grid_from_rows(spark, [("male", 1.0, 1, 1, 1), ("male", 1.0, 2, 2, 2)]))
    with pytest.raises(GridError, match="NULL or NaN"):
        validate_grid(grid_from_rows(spark, [("male", 1.0, float("nan"), 1, 1)]))
    st = validate_grid(grid_from_rows(spark, [("male", 1.0, 1, 1, 1), ("female", 3.0, 1, 1, 1)]))
    label_bytes = st.pop("label_bytes")
    assert st == {"n": 2, "min": 1.0, "max": 3.0, "n_groups": 2}
    assert label_bytes == len("female")  # the longest label
