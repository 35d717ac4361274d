"""Snapshots behind a pointer: replace without a moment in between."""

import pytest
from pyspark.sql import functions as F

from anthro.constants import OUTPUT_COLUMNS
from anthro.sources import snapshots as S
from anthro.sources.sinks import RECORD_SCHEMA, write_zscores

SITES = ["a", "b b/=%", None]


def records(spark, sites, mark, n=3):
    rows = spark.createDataFrame([(s, i) for s in sites for i in range(n)], "site_id string, i long")
    cols = {f.name: F.lit(None).cast(f.dataType) for f in RECORD_SCHEMA}
    cols |= {"site_id": F.col("site_id"), "measurement_id": F.col("i"), "value_source_value": F.lit(mark)}
    return rows.select(*[cols[c].alias(c) for c in OUTPUT_COLUMNS])


def seen(spark, path):
    return sorted(((r.site_id, r.value_source_value) for r in S.read_snapshot(spark, path).collect()), key=str)


def want(marks, n=3):
    return sorted(((s, m) for s, m in marks.items() for _ in range(n)), key=str)


def test_replace_all_and_one_site(spark, tmp_path):
    path = f"{tmp_path}/records"
    assert S.read_snapshot(spark, path).count() == 0 and S.read_snapshot(spark, path).schema.names == list(OUTPUT_COLUMNS)
    S.write_snapshot(records(spark, SITES, "one"), path)
    assert seen(spark, path) == want(dict.fromkeys(SITES, "one"))
    S.write_snapshot(records(spark, ["a"], "two"), path, site="a")
    assert seen(spark, path) == want({"a": "two", SITES[1]: "one", None: "one"})
    S.write_snapshot(records(spark, [], "none"), path, site="a")
    assert seen(spark, path) == want({SITES[1]: "one", None: "one"})
    S.write_snapshot(records(spark, [SITES[1]], "three"), path)
    assert seen(spark, path) == want({SITES[1]: "three"})
    assert len(S.drop_unused(spark, path)) == 3 and S.drop_unused(spark, path) == []
    assert seen(spark, path) == want({SITES[1]: "three"})


@pytest.mark.parametrize("step", ["_folders", "_write_text", "_point"])
def test_a_writer_that_dies_between_the_steps(spark, tmp_path, monkeypatch, step):
    """Nothing of the writer runs after its death: no clean-up is counted on."""
    path = f"{tmp_path}/records"
    S.write_snapshot(records(spark, SITES, "old"), path)

    def die(*args):
        raise SystemExit("killed")

    with monkeypatch.context() as m:
        m.setattr(S, step, die)
        for site in (None, "a"):
            with pytest.raises(SystemExit):
                S.write_snapshot(records(spark, ["a"], "new"), path, site=site)
            assert seen(spark, path) == want(dict.fromkeys(SITES, "old"))
    S.write_snapshot(records(spark, ["a"], "new"), path, site="a")
    assert seen(spark, path) == want({"a": "new", SITES[1]: "old", None: "old"})
    S.drop_unused(spark, path)
    assert seen(spark, path) == want({"a": "new", SITES[1]: "old", None: "old"})


def test_death_before_the_rename(spark, tmp_path, monkeypatch):
    """The new pointer is written in full, but not yet renamed."""
    path = f"{tmp_path}/records"
    S.write_snapshot(records(spark, ["a"], "old"), path)
    write = S._write_text

    def write_and_die(spark, file, text):
        write(spark, file, text)
        raise SystemExit("killed")

    with monkeypatch.context() as m:
        m.setattr(S, "_write_text", write_and_die)
        with pytest.raises(SystemExit):
            S.write_snapshot(records(spark, ["a"], "new"), path)
    assert seen(spark, path) == want({"a": "old"})
    assert any(x.startswith("CURRENT.") for x in S.drop_unused(spark, path))


def test_a_reader_keeps_its_snapshot(spark, tmp_path):
    path = f"{tmp_path}/records"
    S.write_snapshot(records(spark, ["a"], "old"), path)
    before = S.read_snapshot(spark, path)
    S.write_snapshot(records(spark, ["a"], "new"), path)
    assert {r.value_source_value for r in before.collect()} == {"old"}


def test_foreign_rows_and_overtaken_writers(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/records"
    S.write_snapshot(records(spark, SITES, "old"), path)
    with pytest.raises(ValueError, match="other sites"):
        S.write_snapshot(records(spark, ["a", "c"], "new"), path, site="a")
    folders = S._folders

    def meanwhile(spark, p, snapshot):
        monkeypatch.setattr(S, "_folders", folders)
        S.write_snapshot(records(spark, ["a"], "other"), path)
        return folders(spark, p, snapshot)

    monkeypatch.setattr(S, "_folders", meanwhile)
    with pytest.raises(S.OvertakenError):
        S.write_snapshot(records(spark, ["a"], "mine"), path)
    assert seen(spark, path) == want({"a": "other"})


def test_write_zscores_refuses_other_sites(spark, tmp_path):
    path, old = f"{tmp_path}/plain", records(spark, ["a", "b"], "old")
    write_zscores(old, path)
    with pytest.raises(ValueError, match="not all of site"):
        write_zscores(records(spark, ["a", "b"], "new"), path, site="a")
    assert spark.read.parquet(path).where("value_source_value = 'old'").count() == 6
    write_zscores(old, table="refuse_sites")
    with pytest.raises(ValueError, match="not all of site"):
        write_zscores(records(spark, ["a", "b"], "new"), table="refuse_sites", site="a")
    with pytest.raises(ValueError, match="stored as"):
        write_zscores(old, table="refuse_sites", fmt="orc")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    write_zscores(records(spark, ["a"], "new"), table="refuse_sites", site="a")
    assert spark.conf.get(key) == before
    assert {(r.site_id, r.value_source_value) for r in spark.table("refuse_sites").collect()} == {("a", "new"), ("b", "old")}
    write_zscores(records(spark, ["a"], "all"), table="refuse_sites")
    assert {(r.site_id, r.value_source_value) for r in spark.table("refuse_sites").collect()} == {("a", "all")}
    spark.sql("DROP TABLE refuse_sites")
