"""Real-schema tables: scan pushdown, column pruning, CLI, grid sources."""

import pytest
from pyspark.sql import functions as F

from anthro.cli import main as cli_main
from anthro.plans.inspect import plan_text
from anthro.plans.zscore_job import bmi_zscore
from anthro.session import scratch_path
from anthro.sources.fixtures import fixture_tables
from anthro.sources.grids import read_grid_csv, rule_grid, rule_grid_rows, union_sexes
from anthro.sources.sinks import read_zscores
from anthro.sources.tables import read_source, save_bucketed_by_person

from conftest import SF0001


@pytest.fixture(scope="module")
def stored(spark):
    """The fixture tables written as parquet with their own schema (plus a
    column the job never reads), and the grid as two per-sex CSV files."""
    m, p = fixture_tables(spark, SF0001)
    base = scratch_path(spark, "stored")
    m.withColumn("unused_note", F.lit("x")).write.parquet(f"{base}/measurement")
    p.write.parquet(f"{base}/person")
    rule_grid(spark).write.parquet(f"{base}/grid")
    for sex in ("female", "male"):
        rows = [r[1:] for r in rule_grid_rows() if r[0] == sex]
        spark.createDataFrame([tuple(repr(v) for v in r) for r in rows], "age string, l string, m string, s string") \
            .coalesce(1).write.option("header", True).csv(f"{base}/grid_{sex}")
    return base


def test_filters_and_columns_reach_the_scan(spark, stored):
    m = read_source(spark, f"{stored}/measurement", "parquet")
    p = read_source(spark, f"{stored}/person", "parquet")
    g = read_source(spark, f"{stored}/grid", "parquet")
    plan = plan_text(bmi_zscore(m, p, g, site="site_1"))
    scan = [b for b in plan.split("\n\n") if "Scan parquet" in b and "/measurement]" in b][0]
    for f in ("EqualTo(measurement_concept_id,3038553)", "IsNotNull(value_as_number)",
              "EqualTo(unit_concept_id,9531)", "EqualTo(measurement_type_concept_id,45754907)",
              "IsNotNull(measurement_datetime)", "EqualTo(site_id,site_1)"):
        assert f in scan, f
    assert "unused_note" not in scan.split("ReadSchema")[1]
    person_scan = [b for b in plan.split("\n\n") if "Scan parquet" in b and "/person]" in b][0]
    assert "In(gender_concept_id" in person_scan and "IsNotNull(birth_datetime)" in person_scan


def test_grid_from_csv_per_sex(spark, stored):
    g = read_grid_csv(spark, f"{stored}/grid_female", "female").unionByName(
        read_grid_csv(spark, f"{stored}/grid_male", "male"))
    g2 = union_sexes(spark.read.option("header", True).csv(f"{stored}/grid_female"),
                     spark.read.option("header", True).csv(f"{stored}/grid_male"))
    assert sorted(g2.collect()) == sorted(g.collect())
    a = sorted(g.collect())
    b = sorted(rule_grid(spark).collect())
    assert a == b and len(a) == 438


def test_cli_writes_and_compiles(spark, stored, capsys):
    out = scratch_path(spark, "cli-out")
    args = ["--measurement", f"{stored}/measurement", "--person", f"{stored}/person",
            "--grid-female", f"{stored}/grid_female", "--grid-male", f"{stored}/grid_male",
            "--option", "header=true", "--format", "parquet", "--out", out]
    # the three inputs share one --format; the grid here is the parquet copy
    args_tab = args[:4] + ["--grid", f"{stored}/grid"] + args[8:]
    assert cli_main(args_tab) == 0
    assert read_zscores(spark, out).count() == 863
    assert cli_main(args_tab[:-2] + ["--compile"]) == 0
    assert "== Physical Plan ==" in capsys.readouterr().out
    assert cli_main(["--measurement", "x", "--person", "y"]) == 2
    # per-sex CSV grids (strings, as published) next to parquet tables
    out2 = scratch_path(spark, "cli-out-csv")
    assert cli_main(args[:8] + ["--format", "parquet", "--grid-format", "csv",
                                "--grid-option", "header=true", "--out", out2]) == 0
    assert sorted(read_zscores(spark, out2).collect()) == sorted(read_zscores(spark, out).collect())
    # the original job as it runs: second-nearest brackets, NULL keys lost
    out3 = scratch_path(spark, "cli-out-literal")
    assert cli_main(args_tab[:-1] + [out3, "--neighbor-rank", "2", "--drop-null-rejoin-keys"]) == 0
    assert read_zscores(spark, out3).count() == 754
    out4 = scratch_path(spark, "cli-out-hot")
    assert cli_main(args_tab[:-1] + [out4, "--hot-key-fraction", "0.001"]) == 0
    assert sorted(read_zscores(spark, out4).collect()) == sorted(read_zscores(spark, out).collect())


def test_bucketed_tables_join_without_exchange(spark):
    m, p = fixture_tables(spark, SF0001)
    save_bucketed_by_person(m, "bucketed_measurement", 4)
    save_bucketed_by_person(p, "bucketed_person", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the at-scale join
    try:
        df = bmi_zscore(spark.table("bucketed_measurement"), spark.table("bucketed_person"),
                        rule_grid(spark))
        tree = plan_text(df).split("\n\n(1)")[0]
        assert "SortMergeJoin" in tree
        lines = tree.splitlines()
        at = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln)
        col = lines[at].index("SortMergeJoin")
        sub = []                      # the join's own subtree
        for ln in lines[at + 1:]:
            name_at = len(ln) - len(ln.lstrip(" :+-"))
            if name_at <= col:
                break
            sub.append(ln)
        assert any("Scan parquet" in ln for ln in sub)
        below = [ln for ln in sub if "Exchange" in ln]
        assert below == [], below     # no shuffle on either side of the person join
        assert df.count() == 863
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_join_with_hot_person_split(spark):
    """Bucketed tables, one person with a third of the rows: the split
    strategy keeps the cold join co-located and broadcasts the hot rows."""
    from anthro.operators.skew import join_with_hot_keys
    m, p = fixture_tables(spark, SF0001)
    hot = m.withColumn("person_id", F.when(F.col("measurement_id") % 3 == 0, F.lit(4))
                       .otherwise(F.col("person_id")))
    save_bucketed_by_person(hot, "bucketed_hot_measurement", 4)
    save_bucketed_by_person(p, "bucketed_person_2", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bm, bp = spark.table("bucketed_hot_measurement"), spark.table("bucketed_person_2")
        out = join_with_hot_keys(bm, bp, "person_id", hot_fraction=0.2, strategy="split")
        tree = plan_text(out).split("\n\n(1)")[0]
        assert "SortMergeJoin" in tree and "BroadcastHashJoin" in tree
        assert [ln for ln in tree.splitlines() if "Exchange" in ln and "Broadcast" not in ln] == []
        assert sorted(out.collect()) == sorted(bm.join(bp, "person_id").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
