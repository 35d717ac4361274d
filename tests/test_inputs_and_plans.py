"""Typed inputs through the command line, sites in one scan, bucketed joins on two keys, k-th rows, plans as data."""

import random
import time
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from anthro import cli
from anthro.constants import REJOIN_KEYS
from anthro.operators.bracket import bracket_lookup, build_brackets
from anthro.operators.cohort import measurement_cohort
from anthro.operators.rejoin import rejoin_halves
from anthro.operators.topk import kth_per_group
from anthro.plans.inspect import plan_tree
from anthro.plans.zscore_job import bmi_zscore
from anthro.sources.fixtures import fixture_tables, person_from_customer, read_table, site_grid
from anthro.sources.grids import GRID_SCHEMA, rule_grid, validate_grid
from anthro.sources.sinks import read_zscores
from anthro.sources.tables import read_sites, save_bucketed

from conftest import SF0001

NO_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(scope="module")
def inputs(spark):
    return (*fixture_tables(spark, SF0001), rule_grid(spark))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get(NO_BROADCAST)
    spark.conf.set(NO_BROADCAST, "-1")
    yield
    spark.conf.set(NO_BROADCAST, before)


# ------------------------------------------------------------ typed inputs

def run_cli(spark, tmp_path, measurement, person, grid, *more):
    out = f"{tmp_path}/out"
    for df, name in ((measurement, "m"), (person, "p")):
        df.write.option("header", True).csv(f"{tmp_path}/{name}")
    grid.write.option("header", True).csv(f"{tmp_path}/g")
    args = ["--format", "csv", "--option", "header=true", "--measurement", f"{tmp_path}/m", "--person", f"{tmp_path}/p", "--grid", f"{tmp_path}/g", "--out", out, *more]
    assert cli.main(args) == 0
    return read_zscores(spark, out)


def test_csv_grid_by_cli(spark, inputs, tmp_path):
    m, p, g = inputs
    out = run_cli(spark, tmp_path, m, p, g)
    want = bmi_zscore(m, p, g)
    assert out.count() == want.count() == 863
    total = [df.agg(F.sum("value_as_number")).first()[0] for df in (out, want)]
    assert total[0] == pytest.approx(total[1], abs=1e-6)


def test_csv_persons_by_site_by_cli(spark, inputs, tmp_path):
    m, _, g = inputs
    p = person_from_customer(read_table(spark, SF0001, "customer"), by_site=True)
    assert run_cli(spark, tmp_path, m, p, g).count() == bmi_zscore(m, p, g).count() == 881


def test_csv_grid_by_site_by_cli(spark, inputs, tmp_path):
    m, p, g = inputs
    by_site = site_grid(g, 0).withColumn("site_id", F.lit("site_0")).unionByName(site_grid(g, 3).withColumn("site_id", F.lit("site_3")))
    out = run_cli(spark, tmp_path, m, p, by_site)
    want = bmi_zscore(m, p, by_site)
    key = ["measurement_id", "site_id", F.round("value_as_number", 6)]
    assert sorted(map(tuple, out.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
    assert {r.site_id for r in out.select("site_id").distinct().collect()} == {"site_0", "site_3"}


def test_a_grid_of_strings_is_a_grid_of_numbers(spark, inputs):
    m, p, g = inputs
    text = g.select("gender", *[F.col(c).cast("string").alias(c) for c in ("age", "l", "m", "s")])
    assert validate_grid(text) == validate_grid(g)
    for method in ("days", "bracket"):
        assert bmi_zscore(m, p, text, method=method).exceptAll(bmi_zscore(m, p, g, method=method)).count() == 0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NULL or NaN"):
        validate_grid(text.withColumn("age", F.concat("age", F.lit(" months"))))


def test_json_keeps_site_id(spark, inputs, tmp_path):
    from anthro.sources.tables import PERSON_SCHEMA, read_source

    p = person_from_customer(read_table(spark, SF0001, "customer"), by_site=True)
    p.write.json(f"{tmp_path}/p")
    back = read_source(spark, f"{tmp_path}/p", "json", schema=PERSON_SCHEMA)
    assert back.select(p.columns).exceptAll(p).count() == 0 and back.schema["person_id"].dataType == p.schema["person_id"].dataType


# ------------------------------------------------------------ many sites

def test_sites_are_one_scan_with_merged_columns(spark, inputs, tmp_path):
    g = inputs[2]
    folders = {f"s {i}": f"{tmp_path}/grid {i}" for i in range(4)}
    for i, folder in enumerate(folders.values()):
        one = site_grid(g, i)
        one = one.drop("s") if i == 1 else one.withColumn("note", F.lit("x")) if i == 2 else one.withColumn("site_id", F.lit("stale"))
        one.repartition(2).write.parquet(folder if i != 3 else f"{folder}/nested=1/deeper")
    got = read_sites(spark, folders, "parquet")
    assert len(plan_tree(got).find("FileSourceScan")) == 1
    assert set(got.columns) == {"gender", "age", "l", "m", "s", "note", "site_id"}
    rows = {(r.site_id, r.gender, r.age): (r.m, r.s, r.note) for r in got.collect()}
    want = {}
    for i, site in enumerate(folders):
        for r in site_grid(g, i).collect():
            want[site, r.gender, r.age] = (r.m, None if i == 1 else r.s, "x" if i == 2 else None)
    assert rows == want
    files = {site: unquote(spark.read.parquet(folder).inputFiles()[0]) for site, folder in list(folders.items())[:2]}
    assert {r.site_id for r in read_sites(spark, files, "parquet").select("site_id").distinct().collect()} == set(files)


def test_a_thousand_sites_plan_quickly(spark, inputs, tmp_path):
    one = f"{tmp_path}/one"
    inputs[2].coalesce(1).write.parquet(one)
    import os
    import shutil

    file = next(f for f in os.listdir(one) if f.endswith(".parquet"))
    folders = {f"site_{i}": f"{tmp_path}/sites/{i}" for i in range(1000)}
    for f in folders.values():
        os.makedirs(f)
        shutil.copy(f"{one}/{file}", f"{f}/{file}")
    read_sites(spark, dict(list(folders.items())[:40]), "parquet", schema=GRID_SCHEMA)  # the listing code is warm
    start = time.time()
    got = read_sites(spark, folders, "parquet", schema=GRID_SCHEMA)
    tree = plan_tree(got)
    assert time.time() - start < 2
    assert len(tree.find("FileSourceScan")) == 1
    assert got.groupBy("site_id").count().where(f"count = {inputs[2].count()}").count() == 1000


def test_other_sources_are_a_balanced_union(spark, inputs, tmp_path):
    folders = {f"s{i}": f"{tmp_path}/{i}" for i in range(5)}
    for f in folders.values():
        inputs[2].write.option("header", True).csv(f)
    got = read_sites(spark, folders, "csv", {"header": "true"})
    assert got.groupBy("site_id").count().count() == 5


# ------------------------------------------------------------ bucketed by both keys

def test_join_on_two_bucketed_keys_has_no_exchange(spark, inputs, no_broadcast, tmp_path):
    p = person_from_customer(read_table(spark, SF0001, "customer"), by_site=True)
    tables = {}
    for keys in (("site_id", "person_id"), ("person_id",)):
        for name, df in (("m", inputs[0]), ("p", p)):
            tables[name] = f"bucketed_{name}_{len(keys)}"
            save_bucketed(df, tables[name], 4, keys, path=f"{tmp_path}/{tables[name]}")
        cohort = measurement_cohort(spark.table(tables["m"]), spark.table(tables["p"]))
        tree = plan_tree(cohort)
        join, = tree.find("SortMergeJoin")
        assert join.keys == (["site_id", "person_id"], ["site_id", "person_id"])
        assert len(tree.find("ShuffleExchange")) == (0 if len(keys) == 2 else 2)
        assert cohort.exceptAll(measurement_cohort(inputs[0], p)).count() == 0
        for t in tables.values():
            spark.sql(f"DROP TABLE {t}")


# ------------------------------------------------------------ re-join

def test_null_safe_rejoin(spark, inputs, no_broadcast):
    m, p, g = inputs
    c = measurement_cohort(m, p)
    br = build_brackets(g)
    lower, upper = [bracket_lookup(c, br, axis="age_in_months", how="left", sides=s) for s in ("lower", "upper")]
    both = rejoin_halves(lower, upper)
    tree = plan_tree(both)
    join = max(tree.find("SortMergeJoin"), key=lambda n: len(n.keys[0]))
    assert len(join.keys[0]) == 2 * len(REJOIN_KEYS)  # the value or a default, and whether it is NULL
    assert not tree.find("BroadcastNestedLoopJoin|CartesianProduct")
    whole = bracket_lookup(c, br, axis="age_in_months", how="left")
    assert both.select(whole.columns).exceptAll(whole).count() == 0 and both.count() == whole.count() == c.count()
    plain = rejoin_halves(lower, upper, null_safe=False)
    assert plain.count() == c.dropna(subset=list(REJOIN_KEYS)).count() < c.count()


# ------------------------------------------------------------ k-th row

@pytest.mark.parametrize("k", [1, 2, 7])
@pytest.mark.parametrize("descending", [False, True])
def test_kth_per_group(spark, k, descending):
    rng = random.Random(k)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, None]), rng.choice([None, *range(40)]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, x int, id int").repartition(5)

    def key(r):
        return (r[1] is None, (-r[1] if descending else r[1]) if r[1] is not None else 0, -r[2] if descending else r[2])

    want = []
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=key)
        want += mine[k - 1:k]
    got = kth_per_group(df, ["g"], ["x", "id"], k, descending=descending)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    first = kth_per_group(df, ["g"], ["x", "id"], k, descending=descending, first=True, rank_name="rank")
    assert first.groupBy("g").agg(F.max("rank").alias("n"), F.count("*").alias("c")).where("n != c OR n > " + str(k)).count() == 0
    tree = plan_tree(got)
    below = [n for n in tree.find("ShuffleExchange")[0].walk() if n.name == "WindowGroupLimit"]
    assert len(tree.find("WindowGroupLimit")) == 2 and len(below) == 1  # a task sends k rows of a group


def test_kth_row_refuses_what_one_task_would_sort(spark):
    df = spark.range(3).selectExpr("id AS g", "id AS x")
    with pytest.raises(ValueError, match="windowGroupLimitThreshold"):
        kth_per_group(df, ["g"], ["x"], 1001)
    with pytest.raises(ValueError, match="x"):
        kth_per_group(df, ["g"], ["x"], 1, rank_name="x")


# ------------------------------------------------------------ plans as data

def test_plan_nodes(spark, inputs, no_broadcast):
    tree = plan_tree(bmi_zscore(*inputs, method="bracket"))
    join, = tree.find("SortMergeJoin")
    assert join.keys == (["person_id"], ["person_id"])
    lookup, = tree.find("BroadcastHashJoin")
    assert len(lookup.keys[0]) == 2 and "power" not in lookup.condition.lower()
    scan = next(n for n in tree.find("FileSourceScan") if "o_orderkey" in n.columns)
    assert "IsNotNull(o_custkey)" in scan.pushed
    assert [n.partitioning for n in tree.find("ShuffleExchange") if "person_id" in n.partitioning]
    assert all(c.depth == n.depth + 1 for n in tree.walk() for c in n.children)


def z_filter_in_join(tree):
    return [n for n in tree.find(".*Join.*") if n.condition and ("power" in n.condition.lower() or "pow(" in n.condition.lower())]


def test_the_z_filter_stays_out_of_the_join(spark, inputs):
    """And the test itself sees a plan in which it does not."""
    m, p, g = inputs
    assert not z_filter_in_join(plan_tree(bmi_zscore(m, p, g, method="bracket")))
    c = measurement_cohort(m, p)
    looked = bracket_lookup(c, build_brackets(g), axis="age_in_months")  # interpolated without the Generate between
    z = F.pow(F.col("bmi_value") / F.col("m_lo"), F.col("l_lo"))
    assert z_filter_in_join(plan_tree(looked.withColumn("z", z).where(F.col("z").isNotNull() & (F.col("z") < 99))))
