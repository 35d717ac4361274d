"""Grouped bracket lookup by a sorted union of input and grid (an as-of join).

:mod:`bracket` turns the grid into a lookup table, which suits grids that fit
one task.  Here the grid may be as large as the input.  Both are cut into the
same ranges of the axis, and a row is looked up inside its range only:

* the ranges are quantiles of both tables' axis values, so each holds about
  the same number of rows; a value so frequent that several quantiles fall on it
  splits its range by a hash of the row, with the range's grid rows copied;
* every grid row learns its k-th neighbours from its own range and the ``k``
  rows before and after it, taken from a table of the ranges' first and last rows;
* in a range, grid and input rows are sorted together, and each input row takes
  the last grid row before it -- or, before the first, the last of the ranges below.

The input is shuffled once and sorted inside its ranges.  No range, group or
axis value gathers in one task, and nothing but the quantiles reaches the driver.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anthro.operators.bracket import refuse_clash

_G, _A, _ROW, _RANGE, _PART, _GRID, _NEAR = "__sl_group", "__sl_axis", "__sl_row", "__sl_range", "__sl_part", "__sl_grid", "__sl_near"


def axis_cuts(values: DataFrame, parts: int) -> tuple[list[float], list[int]]:
    """Distinct quantiles of the one column of ``values``, ascending, and how many quantiles fall on each."""
    if parts < 2:
        return [], []
    x = F.col(values.columns[0])
    cuts = values.where(x.isNotNull() & ~F.isnan(x)).agg(F.percentile_approx(x, [i / parts for i in range(1, parts)], max(10_000, 20 * parts))).first()[0]
    many = Counter(cuts or [])
    return sorted(many), [many[c] for c in sorted(many)]


def range_of(x: Column, cuts: list[float]) -> Column:
    """How many cuts lie below ``x``, by binary search."""
    if not cuts:
        return F.lit(0)
    table = F.array(*[F.lit(float(c)) for c in cuts])
    steps = F.array(*[F.lit(1 << s) for s in range(len(cuts).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= len(cuts)) & (F.get(table, at + s - 1) < x), at + s).otherwise(at))


def _ranges_of_groups(rows: DataFrame, n: int) -> DataFrame:
    return rows.select(_G).distinct().withColumn(_RANGE, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def _guards(grid: DataFrame, n: int, k: int) -> DataFrame:
    """The ``k`` grid rows before and after each group's ranges, labelled with the range that they guard."""
    inside = Window.partitionBy(_G, _RANGE)
    ends = grid.withColumns({"__up": F.row_number().over(inside.orderBy(_A)), "__down": F.row_number().over(inside.orderBy(F.desc(_A)))})
    ends = ends.where((F.col("__up") <= k) | (F.col("__down") <= k)).select(_G, _RANGE, F.lit(1).alias("__mark"), _A, F.struct(_A, _GRID).alias("__end"))
    nothing = F.lit(None).cast(ends.schema["__end"].dataType)
    marks = _ranges_of_groups(grid, n).withColumn("__mark", F.explode(F.array(F.lit(0), F.lit(2)))) \
        .select(_G, _RANGE, "__mark", F.lit(None).cast("double").alias(_A), nothing.alias("__end"))
    line = ends.unionByName(marks).withColumn("__no", F.lit(1))  # per group: twice k + 2 rows a range
    order = f"OVER (PARTITION BY {_G} ORDER BY {_RANGE}, __mark, {_A})"
    before = ", ".join(f"lag(__end, {j}) IGNORE NULLS {order}" for j in range(1, k + 1))
    after = ", ".join(f"lead(__end, {j}) IGNORE NULLS {order}" for j in range(1, k + 1))
    found = line.selectExpr(_G, _RANGE, "__mark", f"CASE WHEN __mark = 0 THEN array({before}) WHEN __mark = 2 THEN array({after}) END AS __found")
    return found.where("__found IS NOT NULL").select(_G, _RANGE, F.explode("__found").alias("__end")).where("__end IS NOT NULL") \
        .select(_G, _RANGE, f"__end.{_A}", f"__end.{_GRID}")


def _neighbours(grid: DataFrame, n: int, k: int) -> DataFrame:
    """Grid rows with ``__near``: own axis value, k-th row at or below, k-th at or above, k-th above."""
    rows = grid.withColumn("__own", F.lit(True)).unionByName(_guards(grid, n, k).withColumn("__own", F.lit(False)))
    order = f"OVER (PARTITION BY {_G}, {_RANGE} ORDER BY {_A})"
    row = f"struct({_A} AS axis, {_GRID} AS row)"
    at = f"named_struct('axis', {_A}, 'low', lag({row}, {k - 1}) {order}, 'at', lead({row}, {k - 1}) {order}, 'up', lead({row}, {k}) {order})"
    return rows.selectExpr("*", f"{at} AS {_NEAR}").where("__own").select(_G, _RANGE, _A, _NEAR)


def _carried(near: DataFrame, n: int) -> DataFrame:
    """For each range of each group, the last grid row of the ranges below it; below all grid rows, what lies above."""
    last = near.groupBy(_G, _RANGE).agg(F.max_by(_NEAR, _A).alias("__last"), F.min_by(_NEAR, _A).alias("__first"))
    rows = _ranges_of_groups(near, n).join(last, [_G, _RANGE], "left")
    group = Window.partitionBy(_G).orderBy(_RANGE)
    below = F.last("__last", ignorenulls=True).over(group.rowsBetween(Window.unboundedPreceding, -1))
    first = F.first("__first", ignorenulls=True).over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    none = F.lit(None)
    kind = near.schema[_NEAR].dataType
    start = F.struct(none.cast("double").alias("axis"), none.cast(kind["low"].dataType).alias("low"), none.cast(kind["at"].dataType).alias("at"), first["at"].alias("up"))
    return rows.select(_G, _RANGE, F.lit(float("-inf")).alias(_A), F.coalesce(below, start).alias(_NEAR))


def sorted_lookup(df: DataFrame, grid: DataFrame, group: str = "gender", axis: str = "age", values=("l", "m", "s"), k: int = 1, *,
                  input_axis: str | None = None, how: str = "inner", sides: str = "both", parts: int | None = None) -> DataFrame:
    """Attach the bracket of each row of ``df``; the result is that of :func:`bracket_lookup`.

    ``grid`` holds distinct non-null ``(group, axis)`` and is not limited in
    size.  ``parts``: number of ranges (by default the session's shuffle
    partitions).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if sides not in ("both", "lower", "upper"):
        raise ValueError("sides must be 'both', 'lower' or 'upper'")
    if k < 1:
        raise ValueError("neighbour rank k must be >= 1")
    x = input_axis or axis
    lower, upper = f"lower_{axis}", f"upper_{axis}"
    keep = ([lower] + [f"{v}_lo" for v in values] if sides != "upper" else []) + ([upper] + [f"{v}_hi" for v in values] if sides != "lower" else [])
    refuse_clash(df, keep)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = grid.select(F.col(group).alias(_G), F.col(axis).cast("double").alias(_A), F.struct(*[F.col(v).cast("double").alias(v) for v in values]).alias(_GRID))
    cuts, many = axis_cuts(df.select(F.col(x).cast("double").alias(_A)).unionByName(g.select(_A)), parts)
    n = len(cuts) + 1
    g = g.withColumn(_RANGE, range_of(F.col(_A), cuts))
    near = _neighbours(g, n, k)
    copies = F.get(F.array(*[F.lit(m) for m in [*many, 1]]), F.col(_RANGE))

    known = F.col(group).isNotNull() & F.col(x).isNotNull() & ~F.isnan(F.col(x).cast("double"))
    rows = df.select(F.when(known, F.col(group)).alias(_G), F.when(known, F.col(x).cast("double")).alias(_A), F.struct(*[F.col(c) for c in df.columns]).alias(_ROW),
                     F.xxhash64(*[F.col(c) for c in df.columns]).alias("__hash"))
    if how == "inner":
        rows = rows.where(F.col(_G).isNotNull())
    # rows without a group or value meet no grid row and are dealt by hash
    rows = rows.withColumn(_RANGE, F.when(F.col(_G).isNull(), F.lit(-1)).otherwise(range_of(F.col(_A), cuts))) \
        .withColumn(_PART, F.pmod("__hash", F.when(F.col(_RANGE) < 0, F.lit(parts)).otherwise(copies)).cast("int")).drop("__hash")
    table = near.unionByName(_carried(near, n)).withColumn(_PART, F.explode(F.sequence(F.lit(0), copies - 1)))
    table = table.withColumn(_ROW, F.lit(None).cast(rows.schema[_ROW].dataType))
    every = rows.withColumn(_NEAR, F.lit(None).cast(near.schema[_NEAR].dataType)).unionByName(table.select(*rows.columns, _NEAR))
    order = Window.partitionBy(_G, _RANGE, _PART).orderBy(F.col(_A), F.col(_ROW).isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = every.withColumn(_NEAR, F.last(_NEAR, ignorenulls=True).over(order)).where(F.col(_ROW).isNotNull())
    high = F.when(F.col(f"{_NEAR}.axis") == F.col(_A), F.col(f"{_NEAR}.at")).otherwise(F.col(f"{_NEAR}.up"))
    out = out.select(F.col(_ROW), F.col(f"{_NEAR}.low").alias("__low"), high.alias("__high"))
    found = {lower: F.col("__low.axis"), upper: F.col("__high.axis"), **{f"{v}_lo": F.col(f"__low.row.{v}") for v in values},
             **{f"{v}_hi": F.col(f"__high.row.{v}") for v in values}}
    out = out.select(*[F.col(_ROW)[c].alias(c) for c in df.columns], *[found[c].alias(c) for c in keep])
    if how == "inner":
        out = out.dropna(subset=[c for c in (lower, upper) if c in keep])
    return out
