"""Sorted-union lookup against the bracket table and a row-by-row search."""

import random

import pytest
from pyspark.sql import functions as F

from anthro.operators.bracket import bracket_lookup, build_brackets
from anthro.operators.sorted_lookup import axis_cuts, range_of, sorted_lookup
from anthro.operators.zscore import lms_interpolate
from anthro.plans.inspect import plan_tree
from anthro.sources import grids
from anthro.sources.grids import GridError, grid_from_rows, validate_grid

SCHEMA = "id long, gender string, age_in_months double, __hash int"


def case(seed, n=400):
    rng = random.Random(seed)
    axis = {g: sorted(rng.sample(range(0, 60), rng.choice([1, 3, 25]))) for g in ("male", "female", "third")}
    grid = [(g, float(a), rng.random(), rng.random(), rng.random()) for g in axis for a in axis[g]]
    rows = []
    for i in range(n):
        x = rng.choice([17.0, rng.uniform(-5, 65), float(rng.randrange(60)), None, float("nan"), float("inf"), float("-inf")] + [17.0] * 4)
        rows.append((i, rng.choice(["male", "female", "third", "absent", None]), x, 1))
    return grid, rows + rows[:3]


def brute(grid, rows, k, how, sides):
    out = []
    for r in rows:
        x = r[2]
        mine = sorted(g for g in grid if g[0] == r[1]) if x is not None and x == x else []
        low = [g for g in mine if g[1] <= x][::-1]
        high = [g for g in mine if g[1] >= x]
        lo, hi = (low[k - 1] if len(low) >= k else None), (high[k - 1] if len(high) >= k else None)
        need = {"lower": [lo], "upper": [hi], "both": [lo, hi]}[sides]
        if how == "inner" and None in need:
            continue
        found = []
        for side, g in (("lower", lo), ("upper", hi)):
            if sides in (side, "both"):
                found += list(g[1:]) if g else [None] * 4
        out.append((*r, *found))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, k, how, sides, parts", [(1, 1, "inner", "both", 7), (2, 2, "left", "both", 5), (3, 1, "left", "lower", 1), (4, 3, "inner", "upper", 16),
                                                         (5, 2, "inner", "lower", 40), (6, 1, "left", "upper", 3)])
def test_matches_brute_force(spark, seed, k, how, sides, parts):
    grid, rows = case(seed)
    got = sorted_lookup(spark.createDataFrame(rows, SCHEMA), grid_from_rows(spark, grid), "gender", "age", ("l", "m", "s"), k, input_axis="age_in_months", how=how,
                        sides=sides, parts=parts)
    assert sorted(str(tuple(r)) for r in got.collect()) == [str(r) for r in brute(grid, rows, k, how, sides)]


def test_empty_inputs_and_clashes(spark):
    grid, rows = case(9, 20)
    df, g = spark.createDataFrame(rows, SCHEMA), grid_from_rows(spark, grid)
    args = ("gender", "age", ("l", "m", "s"))
    assert sorted_lookup(df.limit(0), g, *args, input_axis="age_in_months").count() == 0
    assert sorted_lookup(df, g.limit(0), *args, input_axis="age_in_months").count() == 0
    left = sorted_lookup(df, g.limit(0), *args, input_axis="age_in_months", how="left")
    assert left.count() == len(rows) and left.where("lower_age IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="l_lo"):
        sorted_lookup(df.withColumn("l_lo", F.lit(1)), g, *args, input_axis="age_in_months")


def test_a_frequent_value_is_split(spark):
    """Two thirds of the rows at one value: its range is dealt over several tasks."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).otherwise(500.0).alias("x"))
    cuts, many = axis_cuts(df, 30)
    assert sum(many) == 29 and many[cuts.index(500.0)] >= 18
    assert df.select(range_of(F.col("x"), cuts).alias("r")).where("x < 500").groupBy("r").count().agg(F.max("count")).first()[0] <= 200


def test_two_million_grid_rows(spark):
    """No limit of the grid, no task with all of it; the result is that of the bracket join on the rows near."""
    grid = spark.range(2_000_000).selectExpr("IF(id % 2 = 0, 'male', 'female') AS gender", "CAST(id AS DOUBLE) / 8 AS age", "-1.0D AS l", "CAST(id AS DOUBLE) AS m", "0.1D AS s")
    st = validate_grid(grid)
    assert (st["n"], st["n_groups"], st["min"], st["max"], st["label_bytes"]) == (2_000_000, 2, 0.0, 1_999_999 / 8, 6)
    df = spark.range(300).selectExpr("IF(id % 3 = 0, 'male', 'female') AS gender", "id", "id * 811.3 AS age_in_months").withColumn("age_in_months", F.col("age_in_months").cast("double"))
    out = lms_interpolate(df, grid)
    rows = out.collect()
    assert len(rows) == 300
    for r in rows[::17]:
        step = [i for i in range(int(r.age_in_months * 8) - 3, int(r.age_in_months * 8) + 4) if i % 2 == (r.gender == "female")]
        low, high = max(i for i in step if i / 8 <= r.age_in_months), min(i for i in step if i / 8 >= r.age_in_months)
        assert (r.lower_age, r.upper_age) == (low / 8, high / 8)
    assert not [n for n in plan_tree(out).walk() if n.name in ("Coalesce", "CartesianProduct", "BroadcastNestedLoopJoin") or "SinglePartition" in (n.partitioning or "")]


def test_large_check_raises_the_same_errors(spark, monkeypatch):
    bad = [("male", float(i), 1.0, 1.0, 1.0) for i in range(10)]
    for limit in (200_000, 3):
        monkeypatch.setattr(grids, "ONE_TASK_GRID_ROWS", limit)
        assert validate_grid(grid_from_rows(spark, bad + [("female", 3.0, 1, 1, 1)])) == {"n": 11, "min": 0.0, "max": 9.0, "n_groups": 2, "label_bytes": 6}
        with pytest.raises(GridError, match="1 duplicate"):
            validate_grid(grid_from_rows(spark, bad + [bad[2]]))
        with pytest.raises(GridError, match="2 row.s. with a NULL or NaN"):
            validate_grid(grid_from_rows(spark, bad + [("male", float("nan"), 1, 1, 1), ("male", 77.0, 1, None, 1)]))


def test_same_as_bracket_lookup_on_a_rank_beyond_a_range(spark):
    grid, rows = case(11)
    df, g = spark.createDataFrame(rows, SCHEMA), grid_from_rows(spark, grid)
    for k in (1, 4):
        a = bracket_lookup(df, build_brackets(g, k=k), axis="age_in_months")
        b = sorted_lookup(df, g, k=k, input_axis="age_in_months", parts=50)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
