"""Equi-join with an explicit split of hot keys.

AQE already splits skewed partitions of a sort-merge join at run time.
This is the explicit form for when one key may own a large share of the
rows (one person with a third of all measurements, say) and the split
should not depend on AQE thresholds:

1. count rows per key on the large side (partial aggregation before the
   shuffle, one row per key after it);
2. bring back at most ``ceil(1 / hot_fraction)`` keys -- no more keys can
   each own that fraction of the rows, so the list is bounded (the
   fraction is at least ``MIN_HOT_FRACTION``);
3. the join runs on ``(key, salt)``: hot rows are spread over ``salt``
   values by a hash of the row, and only the other side's rows of hot keys
   are copied once per salt value.

A hot key never lands in one task, and the large side is scanned once by
the join (plus once, column-pruned, by the key count).

For shuffled joins AQE's skew join does this at run time and is the default.
This module is for inputs bucketed on the key, where AQE has no stage to
split, and for runs that must not depend on AQE thresholds.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_HOT_FRACTION = 0.0005      # at most 2,000 keys come to the driver
ROWS_PER_SALT = 1_000_000
MAX_SALT = 10_000


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _is_one_of(keys: list[str], values: list) -> Column:
    """Whether the key columns equal one of the values (tuples for several columns)."""
    if len(keys) == 1:
        return F.col(keys[0]).isin(values)
    return F.struct(*keys).isin([F.struct(*[F.lit(x).alias(k) for k, x in zip(keys, v, strict=True)])
                                 for v in values])


def _hot_counts(df: DataFrame, key: str | list[str], hot_fraction: float) -> list[tuple]:
    """(key, rows) of the keys owning at least ``hot_fraction`` of the rows of ``df``."""
    if not MIN_HOT_FRACTION <= hot_fraction <= 1:
        raise ValueError(f"hot_fraction must be from {MIN_HOT_FRACTION} to 1")
    keys = _keys(key)
    limit = math.ceil(1.0 / hot_fraction)
    # One row per key; kept so that the top-k and the total read it once.
    # Lost blocks are recomputed from lineage.
    counts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
              .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        total = counts.agg(F.sum("__n")).first()[0] or 0
        top = (counts.dropna(subset=keys)
               .orderBy(F.desc("__n")).limit(limit).collect())  # <= limit rows
    finally:
        counts.unpersist()
    return [(r[keys[0]] if len(keys) == 1 else tuple(r[k] for k in keys), r["__n"])
            for r in top if r["__n"] >= hot_fraction * total]


def find_hot_keys(df: DataFrame, key: str | list[str], hot_fraction: float) -> list:
    """Keys owning at least ``hot_fraction`` of the rows of ``df`` (tuples for several columns)."""
    return [k for k, _ in _hot_counts(df, key, hot_fraction)]


DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def join_with_hot_keys(big: DataFrame, small: DataFrame, key: str | list[str], *,
                       hot_fraction: float = 0.05, how: str = "inner",
                       salt: int | None = None, hot: list | None = None,
                       strategy: str = "salt",
                       max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``big.join(small, key, how)`` with the hot keys of ``big`` salted.

    ``how`` is ``"inner"`` or ``"left"`` (rows of ``big`` are kept).  One
    scan of ``big`` and one join:

    * ``salt`` is by default one value for each ``ROWS_PER_SALT`` rows of the
      hottest key (64 when ``hot`` is given, without counts);
    * a row of ``big`` with a hot key gets ``salt`` = a hash of the whole
      row modulo ``salt`` (deterministic, so a task re-run after an
      executor loss routes every row the same way), and so does a row with a
      NULL key, which has no partner and must not gather in one task; other
      rows get 0;
    * a row of ``small`` with a hot key is copied once per salt value,
      other rows once with 0 -- ``small`` grows by at most
      ``(salt - 1) x`` its rows for the ``<= ceil(1 / hot_fraction)`` hot keys;
    * the join on ``(key, salt)`` spreads each hot key over ``salt`` tasks.

    The planner still picks broadcast or sort-merge from measured sizes.

    ``strategy="split"`` is for inputs bucketed on ``key``, where there is
    no shuffle to salt or for AQE to split: cold rows take the co-located
    join unchanged, hot rows join a broadcast of the other side's hot rows
    (counted first; at most ``max_broadcast_rows``, else the salted form is
    used).  It reads ``big`` twice but never sends a hot key to one task.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if strategy not in ("salt", "split"):
        raise ValueError("strategy must be 'salt' or 'split'")
    keys, most = _keys(key), 0
    if hot is None:
        counted = _hot_counts(big, keys, hot_fraction)
        hot, most = [k for k, _ in counted], max((n for _, n in counted), default=0)
    else:
        hot = list(hot)
    if not hot:
        return big.join(small, keys, how)
    is_hot = F.coalesce(_is_one_of(keys, hot), F.lit(False))
    if strategy == "split":
        small_hot = small.filter(is_hot)
        if small_hot.count() <= max_broadcast_rows:
            cold = big.filter(~is_hot).join(small.filter(~is_hot), keys, how)
            return cold.unionByName(big.filter(is_hot).join(F.broadcast(small_hot), keys, how))
    if salt is None:
        salt = min(MAX_SALT, math.ceil(most / ROWS_PER_SALT)) if most else 64
    s = max(2, int(salt))
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    no_key = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(True)) for k in keys], F.lit(False))
    b = big.withColumn("__salt", F.when(is_hot | no_key, F.pmod(row_hash, F.lit(s))).otherwise(F.lit(0))
                       .cast("int"))
    sm = small.withColumn("__salt", F.explode(
        F.when(is_hot, F.sequence(F.lit(0), F.lit(s - 1))).otherwise(F.array(F.lit(0)))))
    return b.join(sm, [*keys, "__salt"], how).drop("__salt")
