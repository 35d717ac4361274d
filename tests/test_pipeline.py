"""End-to-end job on the driver tables: FIXTURES.md counts, plan shape,
sink, stream, skew split."""

import pytest
from pyspark.sql import functions as F

from anthro.constants import OUTPUT_COLUMNS, REJOIN_KEYS
from anthro.operators.cohort import measurement_cohort
from anthro.operators.skew import find_hot_keys, join_with_hot_keys
from anthro.plans.inspect import plan_text
from anthro.plans.zscore_job import bmi_zscore, run_zscore_job
from anthro.session import scratch_path
from anthro.sources.fixtures import fixture_tables
from anthro.sources.grids import rule_grid
from anthro.sources.sinks import read_zscores

from conftest import SF0001


@pytest.fixture(scope="module")
def inputs(spark):
    m, p = fixture_tables(spark, SF0001)
    return m, p, rule_grid(spark)


def test_fixture_counts(spark, inputs):
    m, p, g = inputs
    assert measurement_cohort(m, p).count() == 1009
    assert bmi_zscore(m, p, g).count() == 863
    assert bmi_zscore(m, p, g, neighbor_rank=2).count() == 861
    drop = ("provider_id", "visit_occurrence_id")
    assert bmi_zscore(m, p, g, drop_null_keys=drop).count() == 756
    assert bmi_zscore(m, p, g, neighbor_rank=2, drop_null_keys=REJOIN_KEYS).count() == 754


def test_methods_agree(spark, inputs):
    m, p, g = inputs
    a = bmi_zscore(m, p, g, method="days")
    b = bmi_zscore(m, p, g, method="bracket")
    assert a.columns == list(OUTPUT_COLUMNS)
    assert sorted(a.collect()) == sorted(b.collect())


def test_entry(spark):
    import __spark_entry__ as E
    from anthro.queries import QUERIES
    df = E.entry(spark)
    assert df.columns == list(OUTPUT_COLUMNS) and df.count() == 863
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def _tree(plan):
    return plan.split("\n\n(1)")[0]


def test_plan_no_shuffle_of_large_side(spark, inputs):
    m, p, g = inputs
    tree = _tree(plan_text(bmi_zscore(m, p, g)))
    lines = tree.splitlines()
    # The lookup is a broadcast hash join keyed on whole days of age.
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree
    full = plan_text(bmi_zscore(m, p, g))
    joins = [b for b in full.split("\n\n") if "BroadcastHashJoin" in b and "Left keys" in b]
    assert any("__age_days" in b.split("Left keys")[1].split("Join type")[0] for b in joins)
    # Every Window / Exchange sits below a BroadcastExchange (grid side only).
    for i, line in enumerate(lines):
        if "Window" in line or ("Exchange" in line and "Broadcast" not in line):
            depth = len(line) - len(line.lstrip(" :+-"))
            assert any("BroadcastExchange" in up and len(up) - len(up.lstrip(" :+-")) < depth
                       for up in lines[:i]), line
    # Filters reach the parquet scan.
    orders = next(b for b in full.split("\n\n") if "Scan parquet" in b and "orders.parquet" in b)
    assert "IsNotNull(o_custkey)" in orders.split("PushedFilters")[1].split("\n")[0]


def test_bracket_plan_is_one_broadcast_join(spark, inputs):
    m, p, g = inputs
    full = plan_text(bmi_zscore(m, p, g, method="bracket"))
    tree = _tree(full)
    assert tree.count("BroadcastHashJoin") == 2          # person + brackets
    assert "__br_bucket" in full


def test_site_filter_and_write_roundtrip(spark, inputs):
    m, p, g = inputs
    path = scratch_path(spark, "test-records")
    run_zscore_job(m, p, g, path)
    back = read_zscores(spark, path)
    assert back.count() == 863
    assert back.filter(F.col("site_id") == "site_0").count() == bmi_zscore(m, p, g, site="site_0").count()
    assert run_zscore_job(m, p, g, scratch_path(spark, "never"), explain_only=True).startswith("== Physical Plan ==")
    # a one-site run replaces that site's folder only
    run_zscore_job(m, p, g, path, site="site_2", version="v9")
    back = read_zscores(spark, path)
    assert back.count() == 863
    labels = {(r["site_id"], r["measurement_source_value"].endswith("v9"))
              for r in back.select("site_id", "measurement_source_value").distinct().collect()}
    assert ("site_2", True) in labels and ("site_2", False) not in labels
    assert {s for s, v9 in labels if not v9} == {"site_0", "site_1", "site_3", "site_4"}


def test_stream_equals_batch(spark, inputs):
    from anthro.streaming.zscore_stream import run_zscore_stream
    m, p, g = inputs
    s = run_zscore_stream(spark, SF0001).select(*OUTPUT_COLUMNS)
    assert sorted(s.collect()) == sorted(bmi_zscore(m, p, g).collect())


def test_stream_resumes_from_checkpoint(spark, inputs):
    """Order files arrive in two batches; the second run on the same
    checkpoint processes only the new file, and the sink holds every row
    once -- equal to the batch job over all orders."""
    from anthro.streaming.zscore_stream import run_zscore_stream
    m, p, g = inputs
    orders = spark.read.parquet(f"{SF0001}/orders.parquet")
    src = scratch_path(spark, "orders-arriving")
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    orders.filter("o_orderkey % 2 = 0").coalesce(1).write.parquet(src)
    first = run_zscore_stream(spark, SF0001, orders_dir=src, glob="*.parquet", out=out,
                              checkpoint=ckpt).count()
    orders.filter("o_orderkey % 2 = 1").coalesce(1).write.mode("append").parquet(src)
    both = run_zscore_stream(spark, SF0001, orders_dir=src, glob="*.parquet", out=out,
                             checkpoint=ckpt).select(*OUTPUT_COLUMNS)
    batch = bmi_zscore(m, p, g)
    assert 0 < first < both.count()
    assert sorted(both.collect()) == sorted(batch.collect())


def test_hot_key_split(spark, inputs):
    m, p, _ = inputs
    # One person owns a third of the measurements.
    skewed = m.withColumn("person_id", F.when(F.col("measurement_id") % 3 == 0, F.lit(4))
                          .otherwise(F.col("person_id")))
    assert find_hot_keys(skewed, "person_id", 0.2) == [4]
    a = join_with_hot_keys(skewed, p, "person_id", hot_fraction=0.2)
    b = skewed.join(p, "person_id")
    assert sorted(a.collect()) == sorted(b.collect())
    c = join_with_hot_keys(skewed, p, "person_id", hot_fraction=0.2, salt=4)
    assert sorted(c.collect()) == sorted(b.collect())
    # the hot person's rows are spread over the salt values
    spread = (skewed.filter("person_id = 4")
              .select(F.pmod(F.xxhash64(*skewed.columns), F.lit(64)).alias("s")).distinct().count())
    assert spread > 32
    # left join keeps unmatched rows on both paths
    d = join_with_hot_keys(skewed, p.filter("person_id % 2 = 0"), "person_id", hot_fraction=0.2, how="left")
    e = skewed.join(p.filter("person_id % 2 = 0"), "person_id", "left")
    assert sorted(d.collect()) == sorted(e.collect())
