"""Joining the two halves of a lookup again (the original job's nine-key join)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.constants import REJOIN_KEYS


def rejoin_halves(lower: DataFrame, upper: DataFrame, keys=REJOIN_KEYS, *, null_safe: bool = True) -> DataFrame:
    """Rows of ``lower`` with the columns that only ``upper`` has, joined on ``keys``.

    ``null_safe``: NULL keys are equal, so no row is lost; Spark turns the
    comparison into hash and sort keys (the value or a default, and whether
    it is NULL), and both sides are shuffled on all of them: one person or
    site with many rows is spread by its measurement ids.  Otherwise rows
    with a NULL in any key are lost, as in the original job.
    """
    keys = list(keys)
    extra = [c for c in upper.columns if c not in lower.columns]
    right = upper.select(*[F.col(c).alias(f"__re_{c}") for c in keys], *extra)
    same = [F.col(c).eqNullSafe(F.col(f"__re_{c}")) if null_safe else F.col(c) == F.col(f"__re_{c}") for c in keys]
    return lower.join(right, reduce(lambda a, b: a & b, same)).select(*lower.columns, *extra)
