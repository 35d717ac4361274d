"""Writing z-score records (OP-S6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anthro.constants import OUTPUT_COLUMNS
from anthro.session import scratch_path

# Types of the written records.  Reading with them keeps a site id such as
# "001" a string: without a declared schema Spark infers the type of a
# partition column from its folder names.
RECORD_SCHEMA = T.StructType([
    T.StructField("measurement_id", T.LongType()),
    T.StructField("person_id", T.LongType()),
    T.StructField("measurement_concept_id", T.IntegerType()),
    T.StructField("measurement_date", T.DateType()),
    T.StructField("measurement_datetime", T.TimestampNTZType()),
    T.StructField("measurement_type_concept_id", T.IntegerType()),
    T.StructField("unit_concept_id", T.IntegerType()),
    T.StructField("unit_source_value", T.StringType()),
    T.StructField("value_as_number", T.DoubleType()),
    T.StructField("value_source_value", T.StringType()),
    T.StructField("measurement_source_value", T.StringType()),
    T.StructField("measurement_source_concept_id", T.IntegerType()),
    T.StructField("measurement_age_in_months", T.DoubleType()),
    T.StructField("site_id", T.StringType()),
    T.StructField("provider_id", T.LongType()),
    T.StructField("visit_occurrence_id", T.LongType()),
])


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _rename(fs, src, dst) -> None:
    if not fs.rename(src, dst):
        raise OSError(f"could not move {src} to {dst}")


def _put(spark: SparkSession, new: str, target: str) -> None:
    """Move folder ``new`` to ``target``; an old ``target`` goes only once the new one is in place."""
    fs, t = _fs(spark, target)
    n = _fs(spark, new)[1]
    if not fs.exists(t):
        fs.mkdirs(t.getParent())
        _rename(fs, n, t)
        return
    old = _fs(spark, f"{target}__old-{uuid.uuid4().hex}")[1]
    _rename(fs, t, old)
    try:
        _rename(fs, n, t)
    except Exception:
        _rename(fs, old, t)
        raise
    fs.delete(old, True)


def _site_folder(spark: SparkSession, site: str) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"site_id={escape(site)}"


def _refuse_other_sites(site: str, found: list[str]) -> None:
    if found:
        raise ValueError(f"the rows are not all of site {site!r}: {', '.join(sorted(found)[:5])}")


def _check_table(spark: SparkSession, table: str, fmt: str) -> None:
    """An existing table must have the format asked for and be partitioned by site alone."""
    provider = [r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name == "Provider"]
    if provider and provider[0].lower() != fmt.lower():
        raise ValueError(f"table {table} is stored as {provider[0]}, not {fmt}")
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if parts != ["site_id"]:
        raise ValueError(f"table {table} is partitioned by {', '.join(parts) or 'nothing'}, not by site_id")


def _session_with(spark: SparkSession, key: str, value: str) -> SparkSession:
    """A session of the same catalog and settings but for one, so that other queries of ``spark`` never see it."""
    aside = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if aside.conf.isModifiable(k):
            aside.conf.set(k, v)
    aside.conf.set(key, value)
    return aside


def _overwrite_path(df: DataFrame, path: str, fmt: str, max_records: int, site: str | None) -> None:
    spark, path = df.sparkSession, path.rstrip("/")
    new = f"{path}__new-{uuid.uuid4().hex}"  # beside the target: moves stay in one file system
    try:
        df.write.format(fmt).partitionBy("site_id").option("maxRecordsPerFile", max_records).save(new)
        if site is None:
            _put(spark, new, path)
            return
        folder = _site_folder(spark, site)
        fs, staged = _fs(spark, f"{new}/{folder}")
        names = [x.getPath().getName() for x in fs.listStatus(_fs(spark, new)[1])]
        _refuse_other_sites(site, [x for x in names if x.startswith("site_id=") and x != folder])
        if fs.exists(staged):
            _put(spark, f"{new}/{folder}", f"{path}/{folder}")
        else:
            fs.delete(_fs(spark, f"{path}/{folder}")[1], True)
            fs.mkdirs(_fs(spark, path)[1])
    finally:
        fs, n = _fs(spark, new)
        if fs.exists(n):
            fs.delete(n, True)


def _overwrite_table(df: DataFrame, table: str, fmt: str, max_records: int, site: str | None) -> None:
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.format(fmt).partitionBy("site_id").option("maxRecordsPerFile", max_records).saveAsTable(table)
        return
    _check_table(spark, table, fmt)
    # Compute first, into scratch files; the table is touched only by a copy of finished rows.
    path = scratch_path(spark, "zscore-table")
    try:
        df.write.parquet(path)
        done = spark.read.schema(df.schema).parquet(path).select(*spark.table(table).columns)
        if site is not None:
            other = done.where(~F.col("site_id").eqNullSafe(F.lit(site))).select("site_id").limit(5).collect()
            _refuse_other_sites(site, [f"site_id={r.site_id}" for r in other])
            if done.isEmpty():
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (site_id = '{site.replace(chr(39), chr(39) * 2)}')")
                return
        aside = _session_with(spark, "spark.sql.sources.partitionOverwriteMode", "static" if site is None else "dynamic")
        full = table if "." in table else f"{spark.catalog.currentDatabase()}.{table}"
        aside.read.schema(df.schema).parquet(path).select(*done.columns).write.option("maxRecordsPerFile", max_records).insertInto(full, overwrite=True)
        spark.catalog.refreshTable(table)  # this session may have listed the replaced files
    finally:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            fs.delete(p, True)


def write_zscores(df: DataFrame, path: str | None = None, *, table: str | None = None,
                  fmt: str = "parquet", mode: str = "overwrite",
                  max_records_per_file: int = 5_000_000, rebalance: bool = False,
                  site: str | None = None) -> None:
    """Write records partitioned by ``site_id`` (one folder per site).

    By default there is no shuffle: every task writes its rows, and
    ``maxRecordsPerFile`` bounds file sizes.  ``rebalance`` adds Spark's
    REBALANCE hint on ``site_id``, a shuffle of the whole output after which
    each site has few, well-sized files (AQE splits a site with a large share).

    ``mode="overwrite"`` never leaves a half-written result: a path is written
    beside its target and then moved into place, a table is filled by a copy of
    rows computed before, so a failing row or executor leaves the old data.
    Between the two moves of a path, or during a table's copy, readers may see
    it incomplete (:mod:`anthro.sources.snapshots` has no such moment).  Errors are raised, never swallowed.

    ``site`` says that ``df`` holds one site (rows of another are refused): only that site's folder or table
    partition is replaced, and it ends empty when ``df`` has no rows.  A NULL or
    empty site id is stored as, and read back as, NULL.
    """
    if (path is None) == (table is None):
        raise ValueError("give a path or a table")
    if rebalance:
        df = df.hint("rebalance", "site_id")
    if mode != "overwrite":
        w = df.write.mode(mode).format(fmt).partitionBy("site_id").option("maxRecordsPerFile", max_records_per_file)
        w.saveAsTable(table) if table else w.save(path)
    elif table:
        _overwrite_table(df, table, fmt, max_records_per_file, site)
    else:
        _overwrite_path(df, path, fmt, max_records_per_file, site)


def read_zscores(spark: SparkSession, path: str, schema=RECORD_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """Read records back with the record types, in the record column order."""
    return spark.read.format(fmt).schema(schema).load(path).select(*OUTPUT_COLUMNS)
