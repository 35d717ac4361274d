"""

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables (``orders`` -> measurement, ``customer`` -> person).  The
matching DuckDB statements are in :mod:`anthro.oracle`.  z is rounded to
6 decimals, as there.
"""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anthro.constants import COHORT_COLUMNS, OUTPUT_COLUMNS, REJOIN_KEYS
from anthro.functions.codes import gender_decode, source_label
from anthro.functions.dates import age_in_months
from anthro.operators.bracket import bracket_lookup, build_brackets
from anthro.operators.cohort import measurement_cohort, select_measurements, select_persons
from anthro.operators.day_table import build_day_table
from anthro.operators.rejoin import rejoin_halves
from anthro.operators.sorted_lookup import sorted_lookup
from anthro.operators.topk import kth_per_group
from anthro.operators.zscore import lms_interpolate, lms_parameters, with_zscore
from anthro.oracle import BY_SITE, RECORDS_PARAMS, ROUND, ZERO_L_AGES
from anthro.plans.zscore_job import bmi_zscore, run_zscore_job
from anthro.session import scratch_path
from anthro.sources.fixtures import N_SITES, fixture_tables, measurement_from_orders, person_from_customer, read_table, site_grid
from anthro.sources.grids import GRID_SCHEMA, rule_grid
from anthro.sources.sinks import read_zscores, write_zscores
from anthro.sources.snapshots import read_snapshot, write_snapshot
from anthro.sources.tables import read_sites, save_bucketed


def _rounded(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(c, ROUND) for c in cols})


_DAY_TABLES: WeakKeyDictionary = WeakKeyDictionary()


def _day_table(spark: SparkSession, k: int = 1):
    """The lookup table of the synthetic grid, checked and built once per session and rank."""
    tables = _DAY_TABLES.setdefault(spark, {})
    if k not in tables:
        tables[k] = build_day_table(rule_grid(spark), k=k)
    return tables[k]


def _inputs(spark: SparkSession, sf_dir: str):
    m, p = fixture_tables(spark, sf_dir)
    return m, p, rule_grid(spark)


def _cohort(spark, sf_dir):
    m, p, g = _inputs(spark, sf_dir)
    return measurement_cohort(m, p), g


def scan_measurement(spark, sf_dir):
    return fixture_tables(spark, sf_dir)[0]


def filter_measurement(spark, sf_dir):
    return select_measurements(fixture_tables(spark, sf_dir)[0])


def filter_person(spark, sf_dir):
    return select_persons(fixture_tables(spark, sf_dir)[1])


def q_gender_decode(spark, sf_dir):
    p = fixture_tables(spark, sf_dir)[1]
    return p.select("person_id", "gender_concept_id", gender_decode("gender_concept_id").alias("gender"))


def q_age_in_months(spark, sf_dir):
    m, p = fixture_tables(spark, sf_dir)
    j = m.join(p, "person_id")
    return j.select("measurement_id", "person_id", "measurement_datetime", "birth_datetime",
                    age_in_months("measurement_datetime", "birth_datetime").alias("age_in_months"))


def q_source_label(spark, sf_dir):
    m = fixture_tables(spark, sf_dir)[0]
    return m.select("measurement_id", "value_source_value",
                    source_label("value_source_value").alias("source_label"))


def q_measurement_cohort(spark, sf_dir):
    return _cohort(spark, sf_dir)[0]


def cohort_multi_site(spark, sf_dir):
    """Sites that use the same person ids for different persons."""
    m = fixture_tables(spark, sf_dir)[0]
    return measurement_cohort(m, person_from_customer(read_table(spark, sf_dir, "customer"), by_site=True))


def _lookup(spark, sf_dir, k=1, how="inner", sides="both", drop_keys=(), **opts):
    c, g = _cohort(spark, sf_dir)
    if drop_keys:
        c = c.dropna(subset=list(drop_keys))
    br = build_brackets(g, "gender", "age", ("l", "m", "s"), k=k, **opts)
    return bracket_lookup(c, br, axis="age_in_months", how=how, sides=sides)


def bracket_lower(spark, sf_dir):
    return _lookup(spark, sf_dir, how="left", sides="lower")


def bracket_upper(spark, sf_dir):
    return _lookup(spark, sf_dir, how="left", sides="upper")


def bracket_lower_rank2(spark, sf_dir):
    """The lower half as the original job runs it: second nearest, rows without one lost."""
    return _lookup(spark, sf_dir, k=2, sides="lower")


def bracket_upper_rank2(spark, sf_dir):
    return _lookup(spark, sf_dir, k=2, sides="upper")


def bracket_rejoin_keys(spark, sf_dir):
    return _lookup(spark, sf_dir, how="left", drop_keys=REJOIN_KEYS)


def q_bracket_lookup(spark, sf_dir):
    return _lookup(spark, sf_dir, k=1)


def bracket_lookup_rank2(spark, sf_dir):
    return _lookup(spark, sf_dir, k=2)


def bracket_lookup_salted(spark, sf_dir):
    """The no-broadcast path: shuffled equi-join on (group, bucket, salt)."""
    return _lookup(spark, sf_dir, k=1, max_broadcast_rows=0, salt=8)


def bracket_lookup_sorted(spark, sf_dir):
    """The lookup for grids of any size: a sorted union of cohort and grid, cut into ranges of the axis."""
    c, g = _cohort(spark, sf_dir)
    return sorted_lookup(c, g, "gender", "age", ("l", "m", "s"), input_axis="age_in_months")


def bracket_rejoin_nullsafe(spark, sf_dir):
    """Lower and upper halves joined again on all nine keys, NULLs equal."""
    c, g = _cohort(spark, sf_dir)
    br = build_brackets(g, "gender", "age", ("l", "m", "s"))
    halves = [bracket_lookup(c, br, axis="age_in_months", how="left", sides=s) for s in ("lower", "upper")]
    return rejoin_halves(*halves).select(*COHORT_COLUMNS, "lower_age", "upper_age", *[f"{v}_{e}" for v in ("l", "m", "s") for e in ("lo", "hi")])


def kth_measurement_per_person(spark, sf_dir):
    """Every person's second measurement from the first and from the last, where one person owns a third of them."""
    m = measurement_from_orders(read_table(spark, sf_dir, "orders"), hot_person=True).where("measurement_datetime IS NOT NULL")
    cols = ["person_id", "measurement_id", "measurement_datetime", "value_as_number"]
    ends = [kth_per_group(m.select(*cols), ["person_id"], ["measurement_datetime", "measurement_id"], 2, descending=d).withColumn("from_last", F.lit(d))
            for d in (False, True)]
    return ends[0].unionByName(ends[1])


def zscore_site_grids(spark, sf_dir):
    """Every site's own grid, stored as one folder a site and read as one scan."""
    m, p, g = _inputs(spark, sf_dir)
    base = scratch_path(spark, "site-grids")
    folders = {f"site_{i}": f"{base}/{i}" for i in range(N_SITES)}
    for i, folder in enumerate(folders.values()):
        site_grid(g, i).coalesce(1).write.parquet(folder)
    return _records(bmi_zscore(m, p, read_sites(spark, folders, "parquet", schema=GRID_SCHEMA)))


def cohort_multi_site_bucketed(spark, sf_dir):
    """The join of sites with equal person ids over tables bucketed on both keys."""
    m = fixture_tables(spark, sf_dir)[0]
    p = person_from_customer(read_table(spark, sf_dir, "customer"), by_site=True)
    stored = []
    for df, name in ((m, "measurement"), (p, "person")):
        path = scratch_path(spark, f"bucketed-{name}")
        table = f"bucketed_{name}_{path.rsplit('-', 1)[-1]}"
        save_bucketed(df.repartition(8, "site_id", "person_id"), table, 8, path=path)
        stored.append(spark.table(table))
    return measurement_cohort(*stored)


def q_lms_interpolate(spark, sf_dir):
    c, g = _cohort(spark, sf_dir)
    return lms_interpolate(c, g, k=1).select(*COHORT_COLUMNS, "lower_age", "upper_age", "l", "m", "s")


def _z(spark, sf_dir, strict, grid=None):
    c = measurement_cohort(*fixture_tables(spark, sf_dir))
    out = with_zscore(lms_parameters(c, grid or _day_table(spark)), strict=strict)
    out = out.select("measurement_id", "person_id", "bmi_value", "age_in_months", "gender",
                     "l", "m", "s", "z_score")
    return _rounded(out, ["z_score"])


def q_lms_zscore(spark, sf_dir):
    return _z(spark, sf_dir, strict=False)


def lms_zscore_log_form(spark, sf_dir):
    """A grid with L = 0 over a range of ages: z takes its logarithmic form there."""
    return _z(spark, sf_dir, strict=False, grid=rule_grid(spark, zero_l=ZERO_L_AGES))


def zscore_strict(spark, sf_dir):
    return _z(spark, sf_dir, strict=True)


def _records(df: DataFrame) -> DataFrame:
    """Records as compared: z rounded, the DATE as its midnight timestamp
    (see :mod:`anthro.oracle`)."""
    return _rounded(df, ["value_as_number"]).withColumn(
        "measurement_date", F.col("measurement_date").cast("timestamp_ntz"))


def q_bmi_zscore(spark, sf_dir):
    m, p = fixture_tables(spark, sf_dir)
    return _records(bmi_zscore(m, p, _day_table(spark)))


def bmi_zscore_bracket(spark, sf_dir):
    """Flagship through the generic bucketed bracket join instead of the
    whole-day table (the path for continuous axes and very wide grids)."""
    m, p, g = _inputs(spark, sf_dir)
    return _records(bmi_zscore(m, p, g, method="bracket"))


def bmi_zscore_literal(spark, sf_dir):
    """As the original job runs: second-nearest brackets, NULL keys lost."""
    m, p = fixture_tables(spark, sf_dir)
    return _records(bmi_zscore(m, p, _day_table(spark, k=2), neighbor_rank=2, drop_null_keys=REJOIN_KEYS))


def q_zscore_records(spark, sf_dir):
    m, p, g = _inputs(spark, sf_dir)
    return _records(bmi_zscore(m, p, g, **RECORDS_PARAMS))


def zscore_by_site(spark, sf_dir):
    m, p = fixture_tables(spark, sf_dir)
    return _records(bmi_zscore(m, p, _day_table(spark), site=BY_SITE))


def zscore_hot_key_split(spark, sf_dir):
    """Flagship with one person who owns a third of the measurements split out explicitly."""
    m = measurement_from_orders(read_table(spark, sf_dir, "orders"), hot_person=True)
    p = fixture_tables(spark, sf_dir)[1]
    return _records(bmi_zscore(m, p, _day_table(spark), hot_key_fraction=0.1))


def write_roundtrip(spark, sf_dir):
    """Write the records partitioned by site to the shared folder, read back."""
    m, p = fixture_tables(spark, sf_dir)
    path = scratch_path(spark, "zscore-records")
    write_zscores(bmi_zscore(m, p, _day_table(spark)), path)
    return _records(read_zscores(spark, path))


def write_snapshot_roundtrip(spark, sf_dir):
    """Write a snapshot of all sites, replace one site's records in a second, read the pointer's."""
    m, p = fixture_tables(spark, sf_dir)
    path = scratch_path(spark, "zscore-snapshots")
    write_snapshot(bmi_zscore(m, p, _day_table(spark)), path)
    write_snapshot(bmi_zscore(m, p, _day_table(spark), site=BY_SITE), path, site=BY_SITE)
    return _records(read_snapshot(spark, path))


def write_table_roundtrip(spark, sf_dir):
    """Write all sites to a table, run one site again into it, read the table back."""
    m, p = fixture_tables(spark, sf_dir)
    path = scratch_path(spark, "zscore-table")
    table = f"zscore_roundtrip_{path.rsplit('-', 1)[-1]}"
    run_zscore_job(m, p, _day_table(spark), table=table)
    run_zscore_job(m, p, _day_table(spark), table=table, site=BY_SITE)
    return _records(spark.table(table).select(*OUTPUT_COLUMNS))


def zscore_stream(spark, sf_dir):
    """The same job as a stream over the order files (availableNow)."""
    from anthro.streaming.zscore_stream import run_zscore_stream
    out = run_zscore_stream(spark, sf_dir)
    return _records(out.select(*OUTPUT_COLUMNS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_measurement": scan_measurement,
    "filter_measurement": filter_measurement,
    "filter_person": filter_person,
    "gender_decode": q_gender_decode,
    "age_in_months": q_age_in_months,
    "source_label": q_source_label,
    "measurement_cohort": q_measurement_cohort,
    "cohort_multi_site": cohort_multi_site,
    "bracket_lower": bracket_lower,
    "bracket_upper": bracket_upper,
    "bracket_lower_rank2": bracket_lower_rank2,
    "bracket_upper_rank2": bracket_upper_rank2,
    "bracket_rejoin_keys": bracket_rejoin_keys,
    "bracket_lookup": q_bracket_lookup,
    "bracket_lookup_rank2": bracket_lookup_rank2,
    "bracket_lookup_salted": bracket_lookup_salted,
    "bracket_lookup_sorted": bracket_lookup_sorted,
    "bracket_rejoin_nullsafe": bracket_rejoin_nullsafe,
    "kth_measurement_per_person": kth_measurement_per_person,
    "zscore_site_grids": zscore_site_grids,
    "cohort_multi_site_bucketed": cohort_multi_site_bucketed,
    "write_snapshot_roundtrip": write_snapshot_roundtrip,
    "lms_interpolate": q_lms_interpolate,
    "lms_zscore": q_lms_zscore,
    "lms_zscore_log_form": lms_zscore_log_form,
    "zscore_strict": zscore_strict,
    "zscore_records": q_zscore_records,
    "bmi_zscore": q_bmi_zscore,
    "bmi_zscore_literal": bmi_zscore_literal,
    "bmi_zscore_bracket": bmi_zscore_bracket,
    "zscore_by_site": zscore_by_site,
    "zscore_hot_key_split": zscore_hot_key_split,
    "write_roundtrip": write_roundtrip,
    "write_table_roundtrip": write_table_roundtrip,
    "zscore_stream": zscore_stream,
}
