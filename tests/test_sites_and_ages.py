"""Persons and grids per site, one age definition, options that must agree, grid limits."""

import datetime

import pytest
from pyspark.sql import functions as F

from anthro.functions.dates import age_in_months
from anthro.operators.bracket import bracket_lookup, build_brackets
from anthro.operators.cohort import DuplicateKeyError, check_unique, measurement_cohort
from anthro.operators.day_table import build_day_table, day_lookup
from anthro.operators.skew import find_hot_keys, join_with_hot_keys
from anthro.operators.zscore import lms_parameters, with_zscore
from anthro.plans.inspect import plan_text
from anthro.plans.zscore_job import bmi_zscore
from anthro.session import scratch_path
from anthro.sources import grids
from anthro.sources.fixtures import fixture_tables, measurement_from_orders, person_from_customer, read_table
from anthro.sources.grids import GridError, rule_grid, validate_grid
from anthro.sources.tables import MEASUREMENT_SCHEMA, PERSON_SCHEMA, read_sites, read_source

from conftest import SF0001


@pytest.fixture(scope="module")
def inputs(spark):
    m, p = fixture_tables(spark, SF0001)
    return m, p, rule_grid(spark)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---------------------------------------------------------------- sites

@pytest.fixture(scope="module")
def persons_by_site(spark):
    return person_from_customer(read_table(spark, SF0001, "customer"), by_site=True)


@pytest.mark.parametrize("opts", [{}, {"hot_key_fraction": 0.001}, {"hot_key_fraction": 0.001, "hot_key_strategy": "split"}])
def test_persons_join_within_their_site(inputs, persons_by_site, opts):
    m, p, _ = inputs
    got = measurement_cohort(m, persons_by_site, **opts)
    assert got.count() == measurement_cohort(m, p).count() == 1009
    for n in range(5):
        one = persons_by_site.filter(F.col("site_id") == f"site_{n}").drop("site_id")
        assert rows(got.filter(F.col("site_id") == f"site_{n}")) == rows(measurement_cohort(m.filter(F.col("site_id") == f"site_{n}"), one))


def test_uniqueness_is_within_a_site(spark, inputs, persons_by_site):
    m, p, g = inputs
    twice = m.unionByName(m.withColumn("site_id", F.lit("site_x")))
    with pytest.raises(DuplicateKeyError):
        bmi_zscore(twice, p, g, require_unique_ids=True)
    bmi_zscore(twice, persons_by_site, g, require_unique_ids=True)
    check_unique(twice, ["site_id", "measurement_id"])
    # rows that the concept filter drops are not looked at
    other = m.unionByName(m.withColumn("measurement_concept_id", F.lit(1)))
    bmi_zscore(other, p, g, require_unique_ids=True)


@pytest.mark.parametrize("method", ["days", "bracket"])
def test_a_grid_per_site(inputs, method):
    m, p, g = inputs
    scale = {"site_0": 1.0, "site_1": 1.1, "site_2": 0.9}
    per_site = None
    for site, x in scale.items():
        one = g.withColumn("m", F.col("m") * x).withColumn("site_id", F.lit(site))
        per_site = one if per_site is None else per_site.unionByName(one)
    got = bmi_zscore(m, p, per_site, method=method)
    for site, x in scale.items():
        alone = bmi_zscore(m, p, g.withColumn("m", F.col("m") * x), site=site, method=method)
        assert rows(got.filter(F.col("site_id") == site)) == rows(alone)
    assert {r.site_id for r in got.select("site_id").distinct().collect()} == set(scale)


def test_read_sites(spark, inputs):
    _, p, _ = inputs
    base = scratch_path(spark, "sites")
    for n in (1, 2):
        p.withColumn("person_id", F.col("person_id") + n).write.parquet(f"{base}/{n}")
    both = read_sites(spark, {"001": f"{base}/1", "b": f"{base}/2"}, fmt="parquet")
    assert both.groupBy("site_id").count().count() == 2 and both.count() == 2 * p.count()
    with pytest.raises(ValueError):
        read_sites(spark, {})


# ---------------------------------------------------------------- one age

def test_the_switch_does_not_change_rows(inputs):
    m, p, g = inputs
    cohort = measurement_cohort(m, p, days_per_month=30.0)
    below = lms_parameters(cohort, g)
    above = lms_parameters(cohort, g, max_day_rows=0)
    assert "__age_days" in plan_text(below) and "__age_days" not in plan_text(above)
    assert rows(below.select(sorted(below.columns))) == rows(above.select(sorted(above.columns)))
    assert rows(lms_parameters(cohort, g, method="days").select("measurement_id", "l")) == rows(lms_parameters(cohort, g, method="bracket").select("measurement_id", "l"))
    # a cohort that does not say how its ages were made is looked up by the ages themselves
    plain = cohort.withColumn("age_in_months", F.col("age_in_months") + 0.0)
    assert rows(lms_parameters(plain, g).select("measurement_id", "l")) == rows(below.select("measurement_id", "l"))


def test_options_must_agree(inputs):
    m, p, g = inputs
    cohort = measurement_cohort(m, p)
    with pytest.raises(ValueError, match="unknown method"):
        lms_parameters(cohort, g, method="typo")
    with pytest.raises(ValueError, match="days_per_month"):
        lms_parameters(cohort, g, days_per_month=30.0)
    table = build_day_table(g)
    with pytest.raises(ValueError, match="rank"):
        bmi_zscore(m, p, table, neighbor_rank=2)
    with pytest.raises(ValueError, match="days_per_month"):
        bmi_zscore(m, p, table, days_per_month=30.0)
    with pytest.raises(ValueError, match="rank"):
        lms_parameters(cohort, build_brackets(g, k=2), k=1)
    with pytest.raises(ValueError):
        lms_parameters(cohort, table, salt=3)
    with pytest.raises(ValueError):
        lms_parameters(cohort, g, method="days", width=1.0)
    assert "__br_salt" in plan_text(lms_parameters(cohort, g, max_broadcast_rows=0, salt=3))


def test_clashing_columns_are_refused(inputs):
    m, p, g = inputs
    cohort = measurement_cohort(m, p)
    for c in ("l", "lower_age", "S_hi"):
        for method in ("days", "bracket"):
            with pytest.raises(ValueError, match="already has"):
                lms_parameters(cohort.withColumn(c, F.lit("x")), g, method=method)
    assert "note" in lms_parameters(cohort.withColumn("note", F.lit("x")), g).columns


def test_day_table_without_broadcast(spark, inputs):
    m, p, g = inputs
    cohort = measurement_cohort(m, p)
    shuffled = build_day_table(g, max_broadcast_bytes=0)
    assert not shuffled.broadcast
    out = day_lookup(cohort, shuffled, "measurement_datetime", "birth_datetime")
    assert rows(out) == rows(day_lookup(cohort, build_day_table(g), "measurement_datetime", "birth_datetime"))


def test_calendar_days(spark):
    def age(at, birth, kind):
        df = spark.createDataFrame([(at, birth)], f"a {kind}, b {kind}")
        return round(df.select(age_in_months("a", "b", 1.0)).first()[0])

    late, early = datetime.datetime(2020, 1, 1, 23, 59, 59), datetime.datetime(2020, 1, 2, 0, 0, 1)
    assert age(early, late, "timestamp_ntz") == 1
    assert age(datetime.datetime(2020, 1, 2, 0, 0), datetime.datetime(2020, 1, 1, 0, 0), "timestamp_ntz") == 1
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone, days in (("UTC", 1), ("America/New_York", 0)):  # instants: the day is that of the session's zone
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.sql("SELECT TIMESTAMP'2020-01-02 00:00:01Z' a, TIMESTAMP'2020-01-01 23:59:59Z' b")
            assert df.select(age_in_months("a", "b", 1.0)).first()[0] == days
            ntz = spark.sql("SELECT TIMESTAMP_NTZ'2020-01-02 00:00:01' a, TIMESTAMP_NTZ'2020-01-01 23:59:59' b")
            assert ntz.select(age_in_months("a", "b", 1.0)).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


# ---------------------------------------------------------------- limits, skew, readers

def test_grid_limits(spark, monkeypatch, inputs):
    m, p, _ = inputs
    small = validate_grid(rule_grid(spark))
    assert small["n"] == 438
    monkeypatch.setattr(grids, "ONE_TASK_GRID_ROWS", 437)  # one row more is checked over several tasks, to the same end
    assert validate_grid(rule_grid(spark)) == small
    wide = spark.createDataFrame([("male", 0.0, -1.0, 16.0, 0.1), ("male", 1e9, -1.0, 16.0, 0.1)], "gender string, age double, l double, m double, s double")
    with pytest.raises(ValueError, match="bracket lookup"):
        build_day_table(wide)


def test_broadcast_is_decided_by_bytes(spark, inputs):
    m, p, g = inputs
    cohort = measurement_cohort(m, p)
    small = build_brackets(g)
    assert small.broadcast and not build_brackets(g, max_broadcast_bytes=10_000).broadcast
    named = g.withColumn("gender", F.concat("gender", F.lit("x" * 100_000)))
    assert not build_brackets(named, max_broadcast_bytes=small.max_rows * 1000).broadcast
    a = bracket_lookup(cohort, build_brackets(g, max_broadcast_bytes=0), axis="age_in_months")
    assert rows(a) == rows(bracket_lookup(cohort, small, axis="age_in_months"))


def test_the_hot_person_is_split(spark, inputs):
    p = inputs[1]
    m = measurement_from_orders(read_table(spark, SF0001, "orders"), hot_person=True)
    plan = plan_text(bmi_zscore(m, p, rule_grid(spark), hot_key_fraction=0.1))
    assert "__salt" in plan
    assert find_hot_keys(m, "person_id", 0.1) == [2]
    with pytest.raises(ValueError):
        find_hot_keys(m, "person_id", 1e-6)


def test_null_keys_do_not_gather(spark):
    big = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS k", "'s' AS t")
    small = spark.range(5000).selectExpr("id AS k", "id * 2 AS v", "'s' AS t")
    want = rows(big.join(small, ["t", "k"], "left").select("id", "k", "v"))
    for keys in ("k", ["t", "k"]):
        right = small if isinstance(keys, list) else small.drop("t")
        got = join_with_hot_keys(big, right, keys, hot_fraction=0.2, how="left", salt=16)
        assert rows(got.select("id", "k", "v")) == want
        plan = plan_text(got)
        assert "__salt" in plan and "isnull" in plan


def test_text_inputs_are_typed(spark, inputs, tmp_path):
    from anthro.cli import main
    from anthro.sources.sinks import read_zscores

    m, p, g = inputs
    m = m.withColumn("site_id", F.lpad(F.substring("site_id", 6, 1), 3, "0"))
    base = scratch_path(spark, "text-inputs")
    m.write.parquet(f"{base}/m_parquet")
    m.select(*reversed(m.columns)).write.option("header", True).option("delimiter", ";").csv(f"{base}/m_csv")
    m.write.json(f"{base}/m_json")
    p.write.parquet(f"{base}/p")
    g.write.parquet(f"{base}/g")

    def run(name, *extra):
        out = f"{base}/out_{name}"
        assert main(["--measurement", f"{base}/m_{name}", "--person", f"{base}/p", "--grid", f"{base}/g", "--format", "parquet", "--out", out, *extra]) == 0
        return rows(read_zscores(spark, out))

    want = run("parquet", "--rebalance")
    assert run("csv", "--measurement-format", "csv", "--measurement-option", "header=true", "--measurement-option", "delimiter=;") == want
    assert run("json", "--measurement-format", "json") == want
    back = read_source(spark, f"{base}/m_csv", "csv", {"header": "true", "delimiter": ";"}, MEASUREMENT_SCHEMA)
    assert dict(back.dtypes) == {f.name: f.dataType.simpleString() for f in MEASUREMENT_SCHEMA}
    assert PERSON_SCHEMA["person_id"].dataType == p.schema["person_id"].dataType


def test_one_task_jdbc_reads_are_refused(spark):
    for opts in ({}, {"partitionColumn": "measurement_id", "numPartitions": "8"}):
        with pytest.raises(ValueError, match="one task"):
            read_source(spark, "t", "jdbc", {"url": "jdbc:none:x", **opts})


def test_log_form(spark, inputs):
    m, p, _ = inputs
    out = with_zscore(lms_parameters(measurement_cohort(m, p), rule_grid(spark, zero_l=(60.0, 140.0))))
    zero = out.filter("l = 0")
    assert zero.count() > 50
    assert zero.filter("abs(z_score - ln(bmi_value / m) / s) > 1e-12").count() == 0
