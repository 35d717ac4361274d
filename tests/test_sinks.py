"""Output: replacing one site, failures leave the old data, types on read-back."""

import uuid

import pytest
from pyspark.sql import functions as F

from anthro.constants import OUTPUT_COLUMNS
from anthro.plans.zscore_job import bmi_zscore, run_zscore_job
from anthro.session import scratch_path
from anthro.sources.fixtures import fixture_tables
from anthro.sources.grids import rule_grid
from anthro.sources.sinks import RECORD_SCHEMA, read_zscores, write_zscores

from conftest import SF0001


@pytest.fixture(scope="module")
def inputs(spark):
    m, p = fixture_tables(spark, SF0001)
    return m, p, rule_grid(spark)


@pytest.fixture(params=["path", "table"])
def sink(request, spark):
    """Keyword arguments of the writer, and how to read back."""
    if request.param == "path":
        path = scratch_path(spark, "sink")
        return {"path": path}, lambda: read_zscores(spark, path)
    table = f"zscores_{uuid.uuid4().hex}"
    return {"table": table}, lambda: spark.table(table).select(*OUTPUT_COLUMNS)


def per_site(df):
    return {r.site_id: (r.n, r.label) for r in df.groupBy("site_id").agg(
        F.count("*").alias("n"), F.max("measurement_source_value").alias("label")).collect()}


def test_one_site_is_replaced(spark, inputs, sink):
    where, back = sink
    run_zscore_job(*inputs, **where)
    before = per_site(back())
    assert sum(n for n, _ in before.values()) == 863 and len(before) == 5
    run_zscore_job(*inputs, **where, site="site_2", version="v9")
    after = per_site(back())
    assert {s: x for s, x in after.items() if s != "site_2"} == {s: x for s, x in before.items() if s != "site_2"}
    assert after["site_2"][0] == before["site_2"][0] and after["site_2"][1].endswith("v9")


def test_a_site_without_rows_ends_empty(spark, inputs, sink):
    where, back = sink
    m, p, g = inputs
    run_zscore_job(m, p, g, **where)
    before = per_site(back())
    run_zscore_job(m.filter("site_id != 'site_2'"), p, g, **where, site="site_2")
    assert per_site(back()) == {s: x for s, x in before.items() if s != "site_2"}


def test_a_full_run_replaces_everything(spark, inputs, sink):
    where, back = sink
    m, p, g = inputs
    run_zscore_job(m, p, g, **where)
    run_zscore_job(m.filter("site_id = 'site_1'"), p, g, **where)
    assert set(per_site(back())) == {"site_1"}


@pytest.mark.parametrize("rebalance", [False, True])
@pytest.mark.parametrize("site", [None, "site_3"])
def test_a_failed_write_leaves_the_old_data(spark, inputs, sink, rebalance, site):
    where, back = sink
    run_zscore_job(*inputs, **where)
    before = sorted(back().collect(), key=str)
    df = bmi_zscore(*inputs, site=site)
    bad = df.withColumn("value_as_number", F.when(F.col("measurement_id") % 97 == 3, F.raise_error(F.lit("bad row")).cast("double"))
                        .otherwise(F.col("value_as_number")))
    with pytest.raises(Exception, match="bad row"):
        write_zscores(bad, **where, rebalance=rebalance, site=site)
    assert sorted(back().collect(), key=str) == before


def test_record_types_survive(spark, inputs, sink):
    where, back = sink
    df = bmi_zscore(*inputs)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RECORD_SCHEMA]
    numbered = df.withColumn("site_id", F.lpad(F.substring("site_id", 6, 1), 3, "0"))
    write_zscores(numbered, **where)
    assert {r.site_id for r in back().select("site_id").distinct().collect()} == {"000", "001", "002", "003", "004"}
    assert dict(back().dtypes) == dict(df.dtypes)


def test_empty_site_id_is_null(spark, inputs):
    path = scratch_path(spark, "sink")
    df = bmi_zscore(*inputs)
    write_zscores(df.withColumn("site_id", F.when(F.col("site_id") == "site_1", "").otherwise(F.col("site_id"))), path)
    back = read_zscores(spark, path)
    assert back.filter("site_id is null").count() == df.filter("site_id = 'site_1'").count() > 0


def test_append_and_arguments(spark, inputs):
    path = scratch_path(spark, "sink")
    df = bmi_zscore(*inputs)
    write_zscores(df, path)
    write_zscores(df, path, mode="append")
    assert read_zscores(spark, path).count() == 2 * 863
    for kw in ({}, {"path": path, "table": "t"}):
        with pytest.raises(ValueError, match="path or a table"):
            write_zscores(df, **kw)


def test_no_shuffle_by_default(spark, inputs):
    from anthro.plans.inspect import plan_text

    assert "REBALANCE" not in plan_text(bmi_zscore(*inputs)).upper()
