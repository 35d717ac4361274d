"""Records as snapshots behind one pointer: a replace that readers never see half done.

Below a path::

    data/<snapshot>/site=<site>/part-...   files of one write, never changed
    CURRENT                                a small JSON file: the folders that count, by site

A write puts its files into a new ``data`` folder, then writes the new pointer
beside the old one and renames it onto it, the only step that readers can see.
A writer that dies before that step has changed nothing; one that dies after it
has finished.  What a replaced or unfinished write leaves behind goes with
:func:`drop_unused`.  Writers of one path take turns: the pointer is checked
once more before the rename, which refuses a writer that was overtaken, but two
renames in the same instant are not told apart.

The rename is atomic on HDFS and local file systems; on object stores the pointer
is a single object, put as a whole.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anthro.constants import OUTPUT_COLUMNS
from anthro.sources.sinks import RECORD_SCHEMA

POINTER = "CURRENT"
NO_SITE = "__none__"


class OvertakenError(RuntimeError):
    """Another writer has replaced the pointer since this one began."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, path: str) -> dict:
    """The pointer: ``{"snapshot": id, "folders": {site: folder below path}}``; empty before the first write."""
    fs, file = _fs(spark, path), _path(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(file):
        return {"snapshot": None, "folders": {}}
    stream = fs.open(file)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _write_text(spark: SparkSession, file: str, text: str) -> None:
    out = _fs(spark, file).create(_path(spark, file), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _point(spark: SparkSession, path: str, pointer: dict) -> None:
    """Replace the pointer by one rename."""
    jvm = spark._jvm
    new = f"{path}/{POINTER}.{uuid.uuid4().hex}"
    _write_text(spark, new, json.dumps(pointer, sort_keys=True))
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration()) \
        if _path(spark, path).toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    files.rename(_path(spark, new), _path(spark, f"{path}/{POINTER}"), options)


def _site_label(site: str | None) -> str:
    return NO_SITE if site in (None, "") else site


def _folders(spark: SparkSession, path: str, snapshot: str) -> dict[str, str]:
    """Folder of each site that the snapshot holds."""
    base = f"{path}/data/{snapshot}"
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    out = {}
    for status in _fs(spark, base).listStatus(_path(spark, base)):
        name = status.getPath().getName()
        if name.startswith("site="):
            out[unescape(name[len("site="):])] = f"data/{snapshot}/{name}"
    return out


def write_snapshot(df: DataFrame, path: str, *, site: str | None = None, max_records_per_file: int = 5_000_000) -> str:
    """Replace the records at ``path`` (of one ``site``, or all) and return the snapshot's id.

    ``site`` says that ``df`` holds one site; the folders of the others stay as
    they are, and a ``df`` with other rows is refused.  A site without rows
    ends empty.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = current(spark, path)
    snapshot = uuid.uuid4().hex
    labelled = df.withColumn("site", F.when(F.coalesce("site_id", F.lit("")) == "", F.lit(NO_SITE)).otherwise(F.col("site_id")))
    labelled.write.partitionBy("site").option("maxRecordsPerFile", max_records_per_file).parquet(f"{path}/data/{snapshot}")
    folders = _folders(spark, path, snapshot)
    if site is not None:
        label = _site_label(site)
        foreign = sorted(set(folders) - {label})
        if foreign:
            raise ValueError(f"rows of other sites than {site!r}: {', '.join(foreign[:5])}")
        folders = {**{s: f for s, f in before["folders"].items() if s != label}, **folders}
    if current(spark, path)["snapshot"] != before["snapshot"]:
        raise OvertakenError(f"{path} was replaced by another writer; run again")
    _point(spark, path, {"snapshot": snapshot, "folders": folders})
    return snapshot


def read_snapshot(spark: SparkSession, path: str, schema=RECORD_SCHEMA) -> DataFrame:
    """The records that the pointer names, as one scan.  A reader keeps its snapshot while it runs, until :func:`drop_unused`."""
    path = path.rstrip("/")
    folders = current(spark, path)["folders"]
    if not folders:
        return spark.createDataFrame([], schema).select(*OUTPUT_COLUMNS)
    # the site is a column of the files too, so folders of several snapshots make one scan
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    return reader.parquet(*[f"{path}/{f}" for f in folders.values()]).select(*OUTPUT_COLUMNS)


def drop_unused(spark: SparkSession, path: str) -> list[str]:
    """Delete the site folders, and pointer drafts, that the pointer does not name; no write or read of older snapshots may be running."""
    path = path.rstrip("/")
    used = set(current(spark, path)["folders"].values())
    fs = _fs(spark, path)
    gone = []
    if fs.exists(_path(spark, f"{path}/data")):
        for status in fs.listStatus(_path(spark, f"{path}/data")):
            snapshot = status.getPath().getName()
            names = _folders(spark, path, snapshot).values()
            unused = sorted(f for f in names if f not in used)
            if len(unused) == len(names):
                unused = [f"data/{snapshot}"]
            gone += unused
    gone += [s.getPath().getName() for s in fs.listStatus(_path(spark, path)) if s.getPath().getName().startswith(f"{POINTER}.")]
    for folder in gone:
        fs.delete(_path(spark, f"{path}/{folder}"), True)
    return gone
