"""LMS parameters per whole day of age: the lookup as a pure equi-join.

Age in months is ``datediff(at, birth) / days_per_month`` -- a whole number
of days over a constant.  Over the range of a grid there are only a few
thousand such day counts per sex (24 to 240.5 months is about 6,600 days),
so the interpolated L, M, S can be computed once per ``(group, day)`` on the
grid side -- each bracket piece emits the whole days inside it -- and the
large side joins on ``(group, day)`` with plain equality:

* no residual join condition, no candidate brackets per row;
* the z-score reads L, M, S as plain columns, so the filter Catalyst pushes
  into the join stays small and the generated code stays JIT-compilable;
* values are bit-equal to interpolating per row: the same IEEE operations
  run in the same order on the same doubles.

The table size is known before it is built,
``rows <= n_groups * ((max - min) * days_per_month + 3) + 2 * n``; it is broadcast
when its proven size in bytes is under the limit, otherwise it is a shuffled
equi-join (AQE splits skewed partitions), and not built beyond
``MAX_DAY_TABLE_ROWS``.  Grids whose range in days is unbounded in
practice are looked up with :func:`anthro.operators.bracket.bracket_lookup`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.constants import DAYS_PER_MONTH
from anthro.operators.bracket import (_FROM, _G, _PT, _TO, DEFAULT_MAX_BROADCAST_BYTES, build_brackets, in_piece,
                                      interpolate, refuse_clash, table_row_bytes)
from anthro.sources.grids import typed_grid, validate_grid

DAY = "__age_days"
# Largest day table that is built at all; wider grids use the bracket lookup.
MAX_DAY_TABLE_ROWS = 50_000_000


@dataclass(frozen=True)
class DayTable:
    df: DataFrame           # group, __age_days, lower_/upper_<axis>, <v>_lo, <v>_hi, <v>
    group: str
    axis: str
    values: tuple
    k: int
    days_per_month: float
    max_rows: int
    broadcast: bool


def day_table_bound(stats: dict, days_per_month: float) -> int:
    """Upper bound on the rows of the day table for a validated grid."""
    span_days = (stats["max"] - stats["min"]) * days_per_month
    return int(stats["n_groups"] * (math.floor(span_days) + 3) + 2 * stats["n"])


def build_day_table(grid: DataFrame, *, group: str = "gender", axis: str = "age",
                    values=("l", "m", "s"), k: int = 1,
                    days_per_month: float = DAYS_PER_MONTH,
                    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                    stats: dict | None = None) -> DayTable:
    """Interpolated parameters for every whole day inside each group's grid."""
    values = tuple(values)
    grid = typed_grid(grid, axis, values)
    st = stats or validate_grid(grid, group, axis, values)
    bound = day_table_bound(st, float(days_per_month))
    if bound > MAX_DAY_TABLE_ROWS:
        raise ValueError(f"the day table could have {bound} rows; use the bracket lookup")
    br = build_brackets(grid, group, axis, values, k=k, stats=st)
    dpm = float(days_per_month)
    # Pieces with both neighbours (finite ends); each emits the whole days
    # d with d / dpm inside it.  A piece spans at most its width in days + 2.
    pieces = br.pieces.filter(F.col(br.lower_col).isNotNull() & F.col(br.upper_col).isNotNull())
    days = pieces.withColumn(DAY, F.explode(F.sequence(
        F.floor(F.col(_FROM) * F.lit(dpm)).cast("int"),
        F.ceil(F.col(_TO) * F.lit(dpm)).cast("int"))))
    # The same expression as anthro.functions.dates.age_in_months.
    days = days.withColumn(axis, F.col(DAY).cast("double") / F.lit(dpm))
    days = days.filter(in_piece(F.col(axis), F.col(_PT), F.col(_FROM), F.col(_TO)))
    table = interpolate(days, axis, values, lower=br.lower_col, upper=br.upper_col)
    table = table.select(F.col(_G).alias(group), DAY, br.lower_col, br.upper_col,
                         *[f"{v}_{e}" for v in values for e in ("lo", "hi")], *values)
    row_bytes = table_row_bytes(len(table.columns), st.get("label_bytes", 64))
    return DayTable(df=table, group=group, axis=axis, values=values, k=k, days_per_month=dpm,
                    max_rows=bound, broadcast=bound * row_bytes <= max_broadcast_bytes)


def day_lookup(df: DataFrame, table: DayTable, at: str, birth: str,
               group: str | None = None) -> DataFrame:
    """Inner equi-join of ``df`` with the day table on (group, whole days).

    Adds ``lower_<axis>``, ``upper_<axis>``, ``<v>_lo``, ``<v>_hi`` and the
    interpolated ``<v>``; rows outside the grid (or with a NULL time or
    group) have no partner and drop out, as in the bracket lookup.
    """
    group = group or table.group
    t = table.df.withColumnRenamed(table.group, "__dt_group")
    refuse_clash(df, [c for c in t.columns if c != "__dt_group"])
    right = F.broadcast(t) if table.broadcast else t
    left = df.withColumn(DAY, F.datediff(F.col(at), F.col(birth)))
    out = left.join(right, (left[group] == right["__dt_group"]) & (left[DAY] == right[DAY]), "inner")
    keep = [c for c in t.columns if c not in ("__dt_group", DAY)]
    return out.select(*[left[c] for c in df.columns], *[right[c] for c in keep])
