"""LMS reference grids.

A grid is a small DataFrame ``(gender, age, l, m, s)``: for each sex the L,
M and S parameters at a set of ages.  It is always an *input* (table,
parquet, CSV or rows); nothing in the job is tied to one published grid.

The repository ships no clinical grid.  :func:`rule_grid_rows` builds a
synthetic grid from a smooth rule on the axis the job is usually run
with (24 to 240.5 months); tests and bench use it so that every number is
reproducible on both sides of the SQL check.  It is *not* a growth
reference and must not be used for real patients.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRID_SCHEMA = T.StructType([
    T.StructField("gender", T.StringType(), False),
    T.StructField("age", T.DoubleType(), False),
    T.StructField("l", T.DoubleType(), False),
    T.StructField("m", T.DoubleType(), False),
    T.StructField("s", T.DoubleType(), False),
])

# One sex of a grid as it is stored, without the sex column, all strings
# (the usual form of a published table).
RAW_GRID_SCHEMA = T.StructType([
    T.StructField("age", T.StringType(), True),
    T.StructField("l", T.StringType(), True),
    T.StructField("m", T.StringType(), True),
    T.StructField("s", T.StringType(), True),
])


# Up to so many rows a grid is checked in one task; beyond, and for its lookup, the work is spread.
ONE_TASK_GRID_ROWS = 200_000

# --- fixed values: the age axis of the grid the job is usually run with ------
AXIS_START, AXIS_FIRST, AXIS_STEPS, AXIS_END = 24.0, 24.5, 216, (240.0, 240.5)
# --- end of fixed values ------------------------------------------------------


class GridError(ValueError):
    """A grid with NULL values, a duplicate (group, axis) key, or too many rows."""


def rule_axis() -> list[float]:
    """24, 24.5, 25.5, 26.5, ..., 239.5, 240, 240.5 (219 points)."""
    return [AXIS_START] + [AXIS_FIRST + i for i in range(AXIS_STEPS)] + list(AXIS_END)


def rule_grid_rows(female_m_factor: float = 0.98, zero_l: tuple[float, float] | None = None) -> list[tuple]:
    """Synthetic (gender, age, l, m, s) rows from smooth quadratics in age.

    The coefficients were chosen by hand so that L, M and S have the sign and
    size of a body-mass grid (L negative, M near 16 to 23, S near 0.1) and bend
    with age; no value is taken from a published grid.  Values are rounded to
    6 decimals so that SQL literals and Spark doubles are the same numbers.
    Female rows are the male rows with M scaled.  ``zero_l`` sets L to 0 for
    ages in that range, where z takes its logarithmic form.
    """
    rows = []
    lo, hi = 24.0, 240.5
    for a in rule_axis():
        t = (a - lo) / (hi - lo)
        l = round(-2.01 + 1.5 * t - 1.33 * t * t, 6)
        if zero_l and zero_l[0] <= a <= zero_l[1]:
            l = 0.0
        m = round(16.6 - 3.0 * t + 9.4 * t * t, 6)
        s = round(0.0806 - 0.02 * t + 0.074 * t * t, 6)
        rows.append(("male", a, l, m, s))
        rows.append(("female", a, l, round(m * female_m_factor, 6), s))
    return rows


def _sql_str(v) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + str(v).replace("'", "''") + "'"


def _sql_double(v) -> str:
    """A double literal; ``repr`` round-trips, ``D`` makes it a double."""
    if v is None:
        return "CAST(NULL AS DOUBLE)"
    v = float(v)
    if v != v or v in (float("inf"), float("-inf")):
        return f"CAST('{v!r}' AS DOUBLE)".replace("'inf'", "'Infinity'").replace("'-inf'", "'-Infinity'")
    return f"{v!r}D"


def grid_from_rows(spark: SparkSession, rows) -> DataFrame:
    """Grid from ``(gender, age, l, m, s)`` tuples (small, driver-held).

    Written as a SQL ``VALUES`` list, so the grid is a local relation in
    the JVM: no Python worker is started for it, and the planner knows its
    exact size.  NULL and NaN are kept (and rejected by :func:`validate_grid`).
    """
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], GRID_SCHEMA)
    vals = ", ".join("(" + ", ".join([_sql_str(r[0])] + [_sql_double(v) for v in r[1:]]) + ")"
                     for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {vals} AS grid(gender, age, l, m, s)")


def raw_sex_table(spark: SparkSession, rows) -> DataFrame:
    """One sex as stored: ``(age, l, m, s)`` all strings, from ``(age, l, m, s)``
    tuples -- the form of a published table before typing (T6)."""
    vals = ", ".join("(" + ", ".join(_sql_str(None if v is None else repr(float(v))) for v in r) + ")"
                     for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {vals} AS raw(age, l, m, s)")


def rule_grid(spark: SparkSession, zero_l: tuple[float, float] | None = None) -> DataFrame:
    """The synthetic grid, built the way a stored grid is read: one string
    table per sex, typed and unioned (:func:`union_sexes`)."""
    rows = rule_grid_rows(zero_l=zero_l)
    by_sex = {g: [r[1:] for r in rows if r[0] == g] for g in ("female", "male")}
    return union_sexes(raw_sex_table(spark, by_sex["female"]), raw_sex_table(spark, by_sex["male"]))


def label_sex(raw: DataFrame, gender: str) -> DataFrame:
    """One stored sex table -> typed grid rows with a ``gender`` literal (and the ``site_id``, if it has one)."""
    site = ["CAST(site_id AS STRING) AS site_id"] if "site_id" in raw.columns else []
    return raw.selectExpr(f"{_sql_str(gender)} AS gender",
                          *[f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in ("age", "l", "m", "s")], *site)


def typed_grid(grid: DataFrame, axis: str = "age", values=("l", "m", "s")) -> DataFrame:
    """``grid`` with its axis and values as doubles.

    A grid read from text has strings, whose order is not that of numbers
    ("100" before "24").  A text that is no number is an error (with ANSI casts,
    Spark's default; without them it becomes NULL, which validation refuses).
    """
    double = {c: F.col("`" + c.replace("`", "``") + "`").cast("double") for c in (axis, *values) if grid.schema[c].dataType != T.DoubleType()}
    return grid.withColumns(double) if double else grid


def union_sexes(female: DataFrame, male: DataFrame) -> DataFrame:
    """Union of the two stored sex tables (OP-S2 + OP-U1), typed."""
    return label_sex(female, "female").unionByName(label_sex(male, "male"))


def read_grid_csv(spark: SparkSession, path: str, gender: str | None = None) -> DataFrame:
    """Read a CSV grid with a header naming ``age, l, m, s`` (and ``gender``
    unless ``gender`` is given).  Columns are taken by name, read as text
    and cast to double (no type inference pass over the file)."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if gender is None:
        return raw.select("gender", *[F.col(c).cast("double").alias(c) for c in ("age", "l", "m", "s")], *(["site_id"] if "site_id" in raw.columns else []))
    return label_sex(raw, gender)


def validate_grid(grid: DataFrame, group: str = "gender", axis: str = "age",
                  values=("l", "m", "s")) -> dict:
    """Check a grid and return its axis statistics.

    Raises :class:`GridError` on a NULL or NaN key/value or a duplicate
    ``(group, axis)``.  A grid is a lookup table, usually of hundreds of rows;
    up to ``ONE_TASK_GRID_ROWS`` (a limit applied while reading) one task
    checks it without a shuffle: rows are ordered within each group, a duplicate
    is a row equal to its predecessor, a group starts at row number 1.  A
    larger grid is checked by :func:`_validate_large`, spread over tasks.  Only
    one row of statistics comes back to the driver.
    """
    grid = typed_grid(grid, axis, values)
    q = {c: "`" + c.replace("`", "``") + "`" for c in (group, axis, *values)}
    g, a = q[group], q[axis]
    bad = " OR ".join([f"{q[c]} IS NULL" for c in (group, axis, *values)]
                      + [f"isnan({q[c]})" for c in (axis, *values)])
    over = f"OVER (PARTITION BY {g} ORDER BY {a})"
    ordered = grid.limit(ONE_TASK_GRID_ROWS + 1).coalesce(1).selectExpr(
        *q.values(), f"lag({a}) {over} AS __prev", f"row_number() {over} AS __rn")
    st = ordered.selectExpr(
        "count(1) AS n",
        f"sum(CASE WHEN {bad} THEN 1 ELSE 0 END) AS n_bad",
        f"min({a}) AS amin",
        f"max({a}) AS amax",
        f"max(octet_length(CAST({g} AS STRING))) AS label_bytes",
        "sum(CASE WHEN __rn = 1 THEN 1 ELSE 0 END) AS n_groups",
        f"sum(CASE WHEN {a} = __prev THEN 1 ELSE 0 END) AS n_dup",
    ).first()
    if st["n"] > ONE_TASK_GRID_ROWS:
        st = _validate_large(grid, q, group, axis, bad)
    n = int(st["n"])
    if n == 0:
        raise GridError("grid is empty")
    if st["n_bad"]:
        raise GridError(f"grid has {st['n_bad']} row(s) with a NULL or NaN field")
    if st["n_dup"]:
        raise GridError(f"grid has {st['n_dup']} duplicate ({group}, {axis}) key(s)")
    return {"n": n, "min": float(st["amin"]), "max": float(st["amax"]),
            "n_groups": int(st["n_groups"]), "label_bytes": int(st["label_bytes"] or 0)}


def _validate_large(grid: DataFrame, q: dict[str, str], group: str, axis: str, bad: str):
    """The same statistics in two phases: rows counted by key (partly before the shuffle), then by group, then over all.

    No sort and no task with all rows; a key that repeats very often is one row from each task.
    """
    g, a = q[group], q[axis]
    keys = grid.selectExpr(f"{g} AS __g", f"{a} AS __a", f"CASE WHEN {bad} THEN 1L ELSE 0L END AS __bad").groupBy("__g", "__a") \
        .agg(F.count("*").alias("n"), F.sum("__bad").alias("bad"))
    groups = keys.groupBy("__g").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.min("__a").alias("amin"), F.max("__a").alias("amax"),
                                     F.sum(F.when(F.col("__a").isNotNull(), F.col("n") - 1)).alias("dup"))
    return groups.agg(F.sum("n").alias("n"), F.sum("bad").alias("n_bad"), F.min("amin").alias("amin"), F.max("amax").alias("amax"),
                      F.max(F.octet_length(F.col("__g").cast("string"))).alias("label_bytes"), F.count("*").alias("n_groups"), F.sum("dup").alias("n_dup")).first()
