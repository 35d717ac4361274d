"""LMS lookup + z-score on a cohort (OP-D2, OP-D3, OP-D4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.functions.dates import DAYS_PER_MONTH_KEY
from anthro.functions.lms import is_valid_z, lms_zscore, strict_z_filter
from anthro.operators.bracket import Brackets, bracket_lookup, build_brackets, interpolate
from anthro.operators.day_table import DayTable, build_day_table, day_lookup, day_table_bound
from anthro.operators.sorted_lookup import sorted_lookup
from anthro.sources.grids import ONE_TASK_GRID_ROWS, typed_grid, validate_grid


def lms_interpolate(cohort: DataFrame, grid_or_brackets, *, k: int = 1,
                    axis: str = "age_in_months", group: str = "gender",
                    how: str = "inner", **bracket_opts) -> DataFrame:
    """Cohort rows with their bracket and interpolated ``l``, ``m``, ``s``.

    ``grid_or_brackets`` is a grid ``(gender, age, l, m, s)`` or a
    :class:`Brackets` built once and reused.  A grid of more than
    ``ONE_TASK_GRID_ROWS`` rows goes through :func:`sorted_lookup`, unless
    options of :func:`build_brackets` are given.
    """
    if not isinstance(grid_or_brackets, Brackets):
        grid = typed_grid(grid_or_brackets)
        stats = bracket_opts.pop("stats", None) or validate_grid(grid, group)
        if stats["n"] > ONE_TASK_GRID_ROWS and not bracket_opts:
            looked = sorted_lookup(cohort, grid, group, "age", ("l", "m", "s"), k, input_axis=axis, how=how)
            return interpolate(looked, axis, ("l", "m", "s"), lower="lower_age", upper="upper_age")
        br = build_brackets(grid, group, "age", ("l", "m", "s"), k=k, stats=stats, **bracket_opts)
    else:
        br = grid_or_brackets
    looked = bracket_lookup(cohort, br, group=group, axis=axis, how=how)
    looked = looked.withColumnsRenamed({br.lower_col: "lower_age", br.upper_col: "upper_age"})
    return interpolate(looked, axis, ("l", "m", "s"), lower="lower_age", upper="upper_age")


SITE_GROUP = "__site_gender"


def _site_group(df: DataFrame) -> DataFrame:
    """``df`` with one group label for site and sex (NULL if either is)."""
    label = F.concat(F.length("site_id").cast("string"), F.lit(":"), F.col("site_id"), F.lit(":"), F.col("gender"))
    return df.withColumn(SITE_GROUP, label)


def _cohort_divisor(cohort: DataFrame, given: float | None) -> float | None:
    """The divisor behind ``age_in_months``, as its column says; ``given`` must agree with it."""
    known = cohort.schema["age_in_months"].metadata.get(DAYS_PER_MONTH_KEY)
    if known is not None and given is not None and known != given:
        raise ValueError(f"the cohort's ages were computed with days_per_month={known}, not {given}")
    return known if known is not None else given


def lms_parameters(cohort: DataFrame, grid, *, k: int | None = None,
                   days_per_month: float | None = None, method: str = "auto",
                   max_day_rows: int = 2_000_000, **bracket_opts) -> DataFrame:
    """Cohort rows inside the grid with ``lower_age``, ``upper_age``, the
    bracketing L/M/S and the interpolated ``l``, ``m``, ``s``.

    ``method="days"`` joins on whole days of age (:mod:`day_table`),
    ``"bracket"`` on the bucketed brackets; ``"auto"`` takes the day table
    when its proven size is at most ``max_day_rows``.  ``grid`` may also be
    a prebuilt :class:`DayTable` or :class:`Brackets`; its rank, and a day
    table's divisor, must agree with ``k`` and the cohort.

    Both ways look up the cohort's own ``age_in_months``: the day table is
    used only with the divisor that column was computed with (which
    :func:`measurement_cohort` records on it), so the choice never changes
    rows.  With a ``site_id`` column the grid is taken per site.
    ``bracket_opts`` are options of :func:`build_brackets`; giving any of
    them chooses the bracket path.
    """
    if method not in ("auto", "days", "bracket"):
        raise ValueError(f"unknown method {method!r}")
    divisor = _cohort_divisor(cohort, days_per_month)
    if isinstance(grid, (DayTable, Brackets)):
        if bracket_opts or method == ("bracket" if isinstance(grid, DayTable) else "days"):
            raise ValueError("a prebuilt table takes no method or build options")
        if k is not None and k != grid.k:
            raise ValueError(f"the prebuilt table has neighbour rank {grid.k}, not {k}")
        if isinstance(grid, Brackets):
            return lms_interpolate(cohort, grid)
        if divisor is not None and divisor != grid.days_per_month:
            raise ValueError(f"the prebuilt table has days_per_month={grid.days_per_month}, the cohort {divisor}")
        return _by_day(cohort, grid)
    k = 1 if k is None else k
    group = "gender"
    if "site_id" in grid.columns:
        grid, cohort, group = _site_group(grid), _site_group(cohort), SITE_GROUP
    if method == "days" and (bracket_opts or divisor is None):
        raise ValueError("method 'days' takes no bracket options and needs the cohort's days_per_month")
    if method == "bracket" or bracket_opts or divisor is None:
        return lms_interpolate(cohort, grid, k=k, group=group, **bracket_opts).drop(SITE_GROUP)
    st = validate_grid(grid, group)
    if method == "auto" and day_table_bound(st, divisor) > max_day_rows:
        return lms_interpolate(cohort, grid, k=k, group=group, stats=st).drop(SITE_GROUP)
    return _by_day(cohort, build_day_table(grid, group=group, k=k, days_per_month=divisor, stats=st)).drop(SITE_GROUP)


def _by_day(cohort: DataFrame, table: DayTable) -> DataFrame:
    out = day_lookup(cohort, table, "measurement_datetime", "birth_datetime")
    return out.withColumnsRenamed({f"lower_{table.axis}": "lower_age",
                                   f"upper_{table.axis}": "upper_age"})


def with_zscore(df: DataFrame, *, value: str = "bmi_value", strict: bool = False,
                max_abs: float = 1e15) -> DataFrame:
    """Add ``z_score`` and keep rows with a finite z.

    Default: NULL z for value 0 with L < 0 (the main job's guard), then keep
    finite z.  ``strict=True``: no zero guard, keep value > 0, M > 0, S > 0
    and ``|z| <= max_abs`` (the job's alternative z-score routine).
    """
    z = lms_zscore(value, "l", "m", "s", zero_guard=not strict)
    out = df.withColumn("z_score", z)
    if strict:
        return out.filter(strict_z_filter(value, "m", "s", "z_score", max_abs))
    return out.filter(is_valid_z("z_score"))
