"""Reading the input tables: catalog table, parquet/ORC path, or JDBC.

The original job reads one database schema per site, one site per run.  Here a source is any DataFrame; these helpers cover the usual
ways to get one.  Column selection and filters applied later are pushed
into the scan by Catalyst.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASUREMENT_SCHEMA = T.StructType([
    T.StructField("measurement_id", T.LongType(), False),
    T.StructField("person_id", T.LongType(), False),
    T.StructField("measurement_concept_id", T.IntegerType(), False),
    T.StructField("measurement_type_concept_id", T.IntegerType(), False),
    T.StructField("unit_concept_id", T.IntegerType(), True),
    T.StructField("value_as_number", T.DoubleType(), True),
    T.StructField("value_source_value", T.StringType(), True),
    T.StructField("measurement_datetime", T.TimestampNTZType(), True),
    T.StructField("site_id", T.StringType(), True),
    T.StructField("provider_id", T.LongType(), True),
    T.StructField("visit_occurrence_id", T.LongType(), True),
])

PERSON_SCHEMA = T.StructType([
    T.StructField("person_id", T.LongType(), False),
    T.StructField("gender_concept_id", T.IntegerType(), True),
    T.StructField("birth_datetime", T.TimestampNTZType(), True),
])


def read_source(spark: SparkSession, source: str, fmt: str = "parquet",
                options: dict | None = None, schema: T.StructType | None = None,
                one_task: bool = False) -> DataFrame:
    """``source`` is a catalog table name (``fmt="table"``), a path, or for
    ``fmt="jdbc"`` a table name with connection ``options`` (url, user...).

    For JDBC pass ``partitionColumn``/``lowerBound``/``upperBound``/
    ``numPartitions`` in ``options`` so the read is split over executors; a
    read without them runs in one task and is refused unless ``one_task``.

    ``schema`` types text formats (CSV, JSON), whose columns would else be
    strings or guessed; other formats carry their own types.  Columns that a
    CSV file with a header, or the first line of a JSON file, has beyond
    ``schema`` stay, as strings: ``site_id`` among them makes persons and grids
    join within their site.
    """
    opts = dict(options or {})
    if fmt == "table":
        return spark.table(source)
    if fmt == "jdbc":
        split = {"partitioncolumn", "lowerbound", "upperbound", "numpartitions"}
        missing = split - {k.lower() for k in opts}
        if missing and not one_task:
            raise ValueError(f"this JDBC read would run in one task: give {', '.join(sorted(missing))}, or one_task=True for a small table")
        return spark.read.format("jdbc").options(dbtable=source, **opts).load()
    reader = spark.read.format(fmt).options(**opts)
    if schema is not None and fmt in ("csv", "json"):
        if fmt == "csv" and str(opts.get("header", "")).lower() == "true":
            # by name: a CSV file's columns may be in any order, or more than these
            raw = reader.load(source)
            typed = [raw[f.name].cast(f.dataType).alias(f.name) for f in schema if f.name in raw.columns]
            return raw.select(*typed, *[raw[c] for c in raw.columns if c not in schema.names])
        if fmt == "json":
            schema = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in _first_json_keys(spark, source) if c not in schema.names]])
        reader = reader.schema(schema)
    return reader.load(source)


def _first_json_keys(spark: SparkSession, source: str) -> list[str]:
    """Names in the first line of a file of JSON lines."""
    for line in spark.read.text(source).limit(1).collect():
        try:
            first = json.loads(line.value)
        except ValueError:
            return []
        return list(first) if isinstance(first, dict) else []
    return []


#: Formats whose files Spark reads by column name, so that one scan may hold files of several sites.
BY_NAME = ("parquet", "orc", "json")


def read_sites(spark: SparkSession, tables: dict[str, str], fmt: str = "table", options: dict | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """One table from a schema (or path) per site: ``{site_id: source}``.

    Each site's rows get its ``site_id`` (an existing column is replaced), so
    persons and grids read this way join within their site.

    Files of a format that is read by name are one scan over all sites' folders; a
    file's folder tells its site.  Their columns are merged: a column that a
    site lacks is NULL there, and a type that differs is an error.  With
    ``schema`` no file is opened for that.  Other sources become a union, built as a
    balanced tree.
    """
    if not tables:
        raise ValueError("no site given")
    if fmt in BY_NAME and len(set(tables.values())) == len(tables):
        return _scan_sites(spark, tables, fmt, dict(options or {}), schema)
    parts = [read_source(spark, source, fmt, options, schema).withColumn("site_id", F.lit(site)) for site, source in tables.items()]
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1], allowMissingColumns=True) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _plain_uri(path: str) -> str:
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def _scan_sites(spark: SparkSession, tables: dict[str, str], fmt: str, options: dict, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.format(fmt).options(**{"mergeSchema": "true", "recursiveFileLookup": "true", **options})
    if schema is not None:
        reader = reader.schema(schema)
    # the folders are listed by a Spark job of one task each; a task may as well list fifty
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(min(int(before), max(8, len(tables) // 50))))
        df = reader.load(list(tables.values()))
    finally:
        spark.conf.set(key, before)
    hadoop = spark._jsc.hadoopConfiguration()
    default = _plain_uri(spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(hadoop).toString()).rstrip("/")

    def root(source: str) -> str:
        if re.match(r"\w+:/", source):
            return _plain_uri(source).rstrip("/")
        if source.startswith("/"):
            return (default + source).rstrip("/")
        p = spark._jvm.org.apache.hadoop.fs.Path(source)  # relative to the file system's working folder
        return _plain_uri(unquote(p.getFileSystem(hadoop).makeQualified(p).toUri().toString())).rstrip("/")

    site_of = {root(source): site for site, source in tables.items()}
    files = [_plain_uri(f) for f in df.inputFiles()]  # the listing that the scan holds anyway; names are URL-encoded
    by_file = any(unquote(f) in site_of for f in files)        # a source is a file, not a folder
    places: dict[str, str] = {}
    for place in {f if by_file else f.rpartition("/")[0] for f in files}:
        at = unquote(place)
        while at and at not in site_of:
            at = at.rpartition("/")[0]
        if not at:
            raise ValueError(f"{place} lies in no site's folder")
        places[place] = site_of[at]
    names = spark.createDataFrame(list(places.items()), "__place string, site_id string")
    if len(places) <= BROADCAST_FOLDERS:
        names = F.broadcast(names)
    file = F.regexp_replace(F.col("_metadata.file_path"), r"^(\w+):/+", "$1:/")
    rows = df.select(*[c for c in df.columns if c != "site_id"], (file if by_file else F.regexp_replace(file, "/[^/]*$", "")).alias("__file"))
    return rows.join(names, F.col("__file") == F.col("__place")).drop("__file", "__place")


BROADCAST_FOLDERS = 200_000


def save_bucketed(df: DataFrame, table: str, buckets: int, keys=("site_id", "person_id"), *, mode: str = "overwrite", fmt: str = "parquet",
                  path: str | None = None) -> None:
    """Store a table bucketed and sorted by all the keys of its join.

    Two tables of one bucket count, bucketed by the keys they join on, need no
    exchange; a layout on some of the keys alone does not do for a join on more
    of them.  Use ``("site_id", "person_id")`` where persons are told apart by
    site, ``("person_id",)`` where they are common to all sites.  Pick
    ``buckets`` so a bucket of the larger table is a few hundred MB.

    Trade-off: without a shuffle there is no stage for AQE to split, and a
    salt column does not force one.  A person who owns a large share of the rows
    then stays in one bucket's task.  Use bucketing for tables without such a
    person; otherwise keep the shuffled join, where AQE or
    ``hot_key_fraction`` splits the hot key.

    ``path`` puts the files there instead of the warehouse.
    """
    writer = df.write.mode(mode).format(fmt).bucketBy(int(buckets), *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def save_bucketed_by_person(df: DataFrame, table: str, buckets: int, *,
                            mode: str = "overwrite", fmt: str = "parquet") -> None:
    """:func:`save_bucketed` for persons common to all sites."""
    save_bucketed(df, table, buckets, ("person_id",), mode=mode, fmt=fmt)
