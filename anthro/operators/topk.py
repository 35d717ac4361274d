"""k-th row of each group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anthro.operators.bracket import refuse_clash

THRESHOLD = "spark.sql.optimizer.windowGroupLimitThreshold"


def kth_per_group(df: DataFrame, group: list[str], order: list[str], k: int = 1, *, descending: bool = False, first: bool = False,
                  rank_name: str | None = None) -> DataFrame:
    """The ``k``-th row of each group in the order of ``order`` (with ``first`` the first ``k`` rows).

    Groups with fewer rows give none (with ``first`` what they have).  Every
    task keeps the first ``k`` rows of a group that it has read and sends no
    more than these (WindowGroupLimit below the shuffle), so the largest
    group arrives as ``k`` rows from each task.  Spark does so up to a limit
    of ``k``; a larger one is refused, as the whole group would be sorted in one task.
    NULLs come last in either direction.  ``order`` should tell a group's
    rows apart, else ties are broken arbitrarily.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    most = int(df.sparkSession.conf.get(THRESHOLD))
    if k > most:
        raise ValueError(f"k = {k} is beyond {THRESHOLD} = {most}; raise that setting if k rows of a group fit a task")
    rank = rank_name or "__kth_rank"
    refuse_clash(df, [rank])
    keys = [F.desc_nulls_last(c) if descending else F.asc_nulls_last(c) for c in order]
    out = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*keys)))
    out = out.where(F.col(rank) <= k if first else F.col(rank) == k)
    return out if rank_name else out.drop(rank)
