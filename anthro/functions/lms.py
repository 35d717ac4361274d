"""LMS z-score as a Spark Column expression (no UDF, stays in codegen).

z = ((x / M) ** L - 1) / (L * S)   when L != 0
z = ln(x / M) / S                  when L == 0

Spark runs with ANSI on, where a double division by zero raises; every
division here is a ``try_divide`` so a bad row gives NULL instead of
failing the job.  ``pow`` of a negative base with a fractional exponent
gives NaN, and NaN IS NOT NULL is true in Spark, so callers keep rows with
``is_valid_z`` (finite, non-null), not with ``isNotNull`` alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lms_zscore(value, l, m, s, zero_guard: bool = True) -> Column:
    """z-score of ``value`` for the LMS parameters ``l``, ``m``, ``s``.

    ``zero_guard`` gives NULL for ``value == 0`` with ``l < 0`` (0 to a
    negative power), as the main job does.  The strict variant
    (``zero_guard=False``) leaves that case to the filter of
    :func:`strict_z_filter`.
    """
    x, l, m, s = _c(value), _c(l), _c(m), _c(s)
    ratio = F.try_divide(x, m)
    box_cox = F.try_divide(F.pow(ratio, l) - F.lit(1.0), l * s)
    log_form = F.try_divide(F.log(ratio), s)  # F.log(<=0) is NULL
    z = F.when(l != 0, box_cox).otherwise(log_form)
    if zero_guard:
        z = F.when((x == 0) & (l < 0), F.lit(None).cast("double")).otherwise(z)
    return z


def is_valid_z(z) -> Column:
    """True for a finite, non-null z (drops NULL, NaN and +-Infinity).

    One comparison does it: ``abs(NULL)`` is NULL, and Spark orders NaN
    above +Infinity, so only finite values are ``< Infinity``.  Keeping z
    to one occurrence matters because Catalyst moves this filter into the
    lookup join's condition.
    """
    return F.abs(_c(z)) < F.lit(float("inf"))


def strict_z_filter(value, m, s, z, max_abs: float = 1e15) -> Column:
    """Guards of the strict variant: value > 0, m > 0, s > 0, |z| <= max_abs.

    ``abs(z) <= max_abs`` is false for NULL, NaN and +-Infinity as well.
    """
    value, m, s, z = _c(value), _c(m), _c(s), _c(z)
    return (value > 0) & (m > 0) & (s > 0) & (F.abs(z) <= F.lit(float(max_abs)))
