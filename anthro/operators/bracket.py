"""Grouped bracket lookup: the k-th nearest grid row at or below and at or
above a value, per group, as one equi-join.

The plain way to write this is two range joins (``grid.age <= x`` and
``grid.age >= x``), a ``row_number`` window per input row on each side and
a self-join of the halves.  On a large input that is a nested-loop join
plus two shuffles of the large side.  Here the grid is turned into
*brackets* instead:

* per group the axis values ``a1 < ... < an`` split the line into points
  ``[ai, ai]`` and open intervals ``(-inf, a1)``, ``(ai, ai+1)``,
  ``(an, +inf)``;
* each piece carries the k-th lower and k-th upper grid row of any value in
  it (found with ``lag``/``lead`` over the small grid);
* each piece is copied to the buckets ``floor(v / width)`` it covers.

The large side then needs only ``floor(x / width)`` and an equi-join on
``(group, bucket)`` with an interval test, which Spark runs as a broadcast
hash join: no shuffle of the large side, no window on it.  Every input
value falls in exactly one piece of its group, so a row matches at most
one bracket.  Inputs beyond the grid are clamped to the outer buckets,
where the infinite pieces live.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anthro.sources.grids import ONE_TASK_GRID_ROWS, typed_grid, validate_grid

# Internal column names of the bracket table (never clash with user columns).
_G, _B, _PT, _FROM, _TO, _SALT, _XB = ("__br_group", "__br_bucket", "__br_point",
                                        "__br_from", "__br_to", "__br_salt", "__br_xbucket")

# Largest lookup table that is broadcast, by its proven size in bytes.
DEFAULT_MAX_BROADCAST_BYTES = 128 << 20


@dataclass(frozen=True)
class Brackets:
    """Bracket table plus what the lookup side needs to compute buckets."""

    df: DataFrame
    group: str
    axis: str
    values: tuple
    k: int
    width: float
    axis_min: float
    axis_max: float
    max_rows: int            # proven upper bound on df's row count
    broadcast: bool
    salt: int                # > 1 only when not broadcast
    pieces: DataFrame | None = None   # one row per piece, before bucketing

    @property
    def lower_col(self) -> str:
        return f"lower_{self.axis}"

    @property
    def upper_col(self) -> str:
        return f"upper_{self.axis}"

    def lo(self, v: str) -> str:
        return f"{v}_lo"

    def hi(self, v: str) -> str:
        return f"{v}_hi"


def table_row_bytes(n_columns: int, label_bytes: int) -> int:
    """Bytes of a row of a lookup table in a hash relation: eight per column and
    label word, plus the row's header and its place in the map."""
    return 8 * (n_columns + 1) + 8 * (-(-label_bytes // 8)) + 64


def refuse_clash(df: DataFrame, new) -> None:
    """Raise if a column to be added exists already (the caller's data would be lost or ambiguous)."""
    have = {c.lower() for c in df.columns}
    clash = [c for c in new if c.lower() in have]
    if clash:
        raise ValueError(f"the input already has column(s) {', '.join(clash)}; rename them first")


def _q(name: str) -> str:
    """A column name quoted for a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def _shift_sql(c: str, n: int, group: str, axis: str) -> str:
    """Value ``n`` rows later (n > 0) / earlier (n < 0) in the group order."""
    if n == 0:
        return _q(c)
    fn = "lead" if n > 0 else "lag"
    return f"{fn}({_q(c)}, {abs(n)}) OVER (PARTITION BY {_q(group)} ORDER BY {_q(axis)})"


def _bucket(x: Column, width: float, lo: float, hi: float) -> Column:
    """floor(clamp(x, lo, hi) / width); NULL for NULL or NaN ``x``."""
    clamped = F.least(F.greatest(x, F.lit(lo)), F.lit(hi))
    return F.when(x.isNull() | F.isnan(x), F.lit(None).cast("long")).otherwise(
        F.floor(clamped / F.lit(width)))


def build_brackets(grid: DataFrame, group: str = "gender", axis: str = "age",
                   values=("l", "m", "s"), k: int = 1, width: float | None = None,
                   max_broadcast_rows: int | None = None,
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                   salt: int = 16, stats: dict | None = None) -> Brackets:
    """Validate ``grid`` and build the bracket table for neighbour rank ``k``.

    ``k = 1`` takes the nearest grid row on each side (a value on a grid
    point gets that point on both sides); ``k = 2`` the second nearest, and
    so on.  ``width`` is the bucket width on the axis; by default a quarter
    of the mean grid spacing: most buckets then lie inside one open
    interval, so an input row meets about 1.5 candidate brackets, and the
    table stays near ``6 x`` the grid size.

    The table size is bounded *before* it is built:
    ``rows <= 2 * n + n_groups * (2 + (max - min) / width)``.
    It is broadcast only when that bound, times the bytes of a row, is at most
    ``max_broadcast_bytes`` (and the rows at most ``max_broadcast_rows``, if
    given); otherwise the lookup is a shuffled equi-join on (group, bucket) with
    the input side salted ``salt`` ways so a hot bucket does not land in one
    task.
    """
    if k < 1:
        raise ValueError("neighbour rank k must be >= 1")
    values = tuple(values)
    grid = typed_grid(grid, axis, values)
    st = stats or validate_grid(grid, group, axis, values)
    n, n_groups, amin, amax = st["n"], st["n_groups"], st["min"], st["max"]
    span = amax - amin
    if width is None:
        width = span * n_groups / (4.0 * n) if span > 0 else 1.0
    if not (width > 0 and math.isfinite(width)):
        raise ValueError("bucket width must be a positive number")
    max_rows = int(2 * n + n_groups * (2 + math.floor(span / width) + 1))
    row_bytes = table_row_bytes(5 + 2 * (1 + len(values)), st.get("label_bytes", 64))
    broadcast = max_rows * row_bytes <= max_broadcast_bytes and (max_broadcast_rows is None or max_rows <= max_broadcast_rows)
    salt = 1 if broadcast else max(1, int(salt))

    # Expressions are written as SQL text (selectExpr): one driver-to-JVM
    # call per projection instead of one per Column node.
    g = grid.select(group, axis, *values)
    if n <= ONE_TASK_GRID_ROWS:
        g = g.coalesce(1)      # one partition already satisfies the window's clustering
    shifted = [f"{_shift_sql(axis, 1, group, axis)} AS __nxt",
               f"row_number() OVER (PARTITION BY {_q(group)} ORDER BY {_q(axis)}) AS __rn"]
    for j in sorted({k - 1, k}):
        for c, tag in [(axis, "a")] + [(v, v) for v in values]:
            shifted.append(f"{_shift_sql(c, j, group, axis)} AS `__{tag}_p{j}`")
            shifted.append(f"{_shift_sql(c, -j, group, axis)} AS `__{tag}_m{j}`")
    g = g.selectExpr("*", *shifted)

    lower_c, upper_c = f"lower_{axis}", f"upper_{axis}"

    def piece(point: bool, frm: str, to: str, lo_key, hi_key) -> list[str]:
        """One piece: interval ends and the k-th lower/upper rows."""
        def pick(tag, key):
            return f"`__{tag}_{key}`" if key else "CAST(NULL AS DOUBLE)"
        cols = [f"{_q(group)} AS {_G}", f"{str(point).lower()} AS {_PT}",
                f"CAST({frm} AS DOUBLE) AS {_FROM}", f"CAST({to} AS DOUBLE) AS {_TO}",
                f"{pick('a', lo_key)} AS {_q(lower_c)}", f"{pick('a', hi_key)} AS {_q(upper_c)}"]
        for v in values:
            cols += [f"{pick(v, lo_key)} AS {_q(v + '_lo')}", f"{pick(v, hi_key)} AS {_q(v + '_hi')}"]
        return cols

    km1 = k - 1
    points = g.selectExpr(*piece(True, _q(axis), _q(axis), f"m{km1}", f"p{km1}"))
    # (a_i, a_{i+1}) and, for the last point, (a_n, +inf): lower is the
    # k-th at or below a_i, upper the k-th at or above a_{i+1}.
    opens = g.selectExpr(*piece(False, _q(axis), "__nxt", f"m{km1}", f"p{k}"))
    # (-inf, a_1): no lower; upper is the k-th from the first point.
    heads = g.filter("__rn = 1").selectExpr(*piece(False, "NULL", _q(axis), None, f"p{km1}"))
    pieces = points.unionByName(opens).unionByName(heads)

    b_from = _bucket(F.coalesce(F.col(_FROM), F.lit(amin)), width, amin, amax)
    b_to = _bucket(F.coalesce(F.col(_TO), F.lit(amax)), width, amin, amax)
    df = pieces.withColumn(_B, F.explode(F.sequence(b_from, b_to)))
    if salt > 1:
        df = df.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return Brackets(df=df, group=group, axis=axis, values=values, k=k, width=float(width),
                    axis_min=amin, axis_max=amax, max_rows=max_rows * salt,
                    broadcast=broadcast, salt=salt, pieces=pieces)


def in_piece(x: Column, point: Column, frm: Column, to: Column) -> Column:
    """x lies in the piece: equal to a point, or strictly inside an interval
    (a NULL end is infinite)."""
    return ((point & (x == frm))
            | (~point & (frm.isNull() | (x > frm)) & (to.isNull() | (x < to))))


def bracket_lookup(df: DataFrame, br: Brackets, group: str | None = None,
                   axis: str | None = None, how: str = "inner",
                   sides: str = "both") -> DataFrame:
    """Attach the bracket of each row of ``df``.

    Adds ``lower_<axis>``, ``upper_<axis>`` and ``<v>_lo`` / ``<v>_hi`` for
    each grid value (only the lower or upper ones for ``sides="lower"`` /
    ``"upper"``).

    ``how="inner"`` keeps rows for which the requested sides exist;
    ``how="left"`` keeps every row, with NULLs where a side is missing
    (values outside the grid, a group absent from the grid, NULL/NaN).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if sides not in ("both", "lower", "upper"):
        raise ValueError("sides must be 'both', 'lower' or 'upper'")
    group = group or br.group
    axis = axis or br.axis
    lower_c, upper_c = br.lower_col, br.upper_col
    keep = []
    if sides in ("both", "lower"):
        keep += [lower_c] + [br.lo(v) for v in br.values]
    if sides in ("both", "upper"):
        keep += [upper_c] + [br.hi(v) for v in br.values]

    refuse_clash(df, keep)
    b = br.df
    if how == "inner":
        need = [lower_c] if sides == "lower" else [upper_c] if sides == "upper" else [lower_c, upper_c]
        for c in need:
            b = b.filter(F.col(c).isNotNull())
    b = b.select(_G, _B, _PT, _FROM, _TO, *keep, *([_SALT] if br.salt > 1 else []))

    x = F.col(axis)
    left = df.withColumn(_XB, _bucket(x, br.width, br.axis_min, br.axis_max))
    if br.salt > 1:
        # Deterministic salt (a hash of the whole row) so a recomputed task
        # after an executor loss routes every row as before.
        left = left.withColumn(_SALT, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]),
                                             F.lit(br.salt)).cast("int"))
    right = F.broadcast(b) if br.broadcast else b
    cond = ((left[group] == right[_G]) & (left[_XB] == right[_B])
            & in_piece(x, right[_PT], right[_FROM], right[_TO]))
    if br.salt > 1:
        cond = cond & (left[_SALT] == right[_SALT])
    out = left.join(right, cond, how)
    return out.select(*[left[c] for c in df.columns], *[right[c] for c in keep])


def interpolate(df: DataFrame, axis: str, values=("l", "m", "s"),
                lower: str | None = None, upper: str | None = None) -> DataFrame:
    """Linear interpolation of each value between its ``_lo`` and ``_hi``.

    ``frac = 0`` when the bounds are equal, else ``(x - lower) / (upper -
    lower)``; ``v = v_lo + frac * (v_hi - v_lo)``.  NULL where a bound is
    missing.

    The values come out of a one-element ``inline`` (a Generate node).  A
    later filter on them -- the z-score validity filter -- then stays above
    it: Catalyst cannot push a predicate on generator output into the
    lookup join, where it would be evaluated per candidate bracket with the
    interpolation inlined several times over.  That inlined condition grew
    past the size the JVM JIT-compiles; with the Generate in between the
    same job ran 2.4x faster at sf0.1 (identical rows).
    """
    x, lo, hi = _q(axis), _q(lower or f"lower_{axis}"), _q(upper or f"upper_{axis}")
    frac = f"CASE WHEN {hi} = {lo} THEN 0.0D ELSE ({x} - {lo}) / ({hi} - {lo}) END"
    interpolated = ", ".join(
        f"CASE WHEN {hi} = {lo} THEN {_q(v + '_lo')} "
        f"ELSE {_q(v + '_lo')} + {frac} * ({_q(v + '_hi')} - {_q(v + '_lo')}) END AS {_q(v)}"
        for v in values)
    refuse_clash(df, values)
    rest = [_q(c) for c in df.columns]
    return df.selectExpr(*rest, f"inline(array(struct({interpolated})))")
