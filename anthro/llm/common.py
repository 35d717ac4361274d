"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anthro.session import scratch_path


#: Arrow batches of at most 500 rows and 4 MB: what a worker holds then follows long texts, not ten thousand of them.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def small_batches(spark: SparkSession) -> None:
    """For the session's whole rest: called by the registered queries, whose result runs after they return."""
    for k, v in BATCHES.items():
        spark.conf.set(k, v)


@contextmanager
def batches_of(spark: SparkSession, conf: dict[str, str] = BATCHES) -> Iterator[None]:
    """Arrow batch sizes for what runs inside; the session's own come back after."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts lineage: what follows depends on files every executor can read, so a
    lost executor never forces the work above to be redone.  The files stay
    until the folder is cleaned, like those of ``checkpoint()``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with batches_of(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_share(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus`` (null for a null key)."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column has it."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def row_ranges(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches cut to about a megabyte of text, so that arrays over bytes stay small."""
    from anthro.llm.textnum import slices

    for b in batches:
        if b.num_rows:
            for lo, hi in slices(column(b, text)):
                yield b.slice(lo, hi - lo)
    give_back()


def give_back() -> None:
    """Free memory goes back to the system, so that a worker that waits for its next task holds little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(),
          "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
          "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64())}


def arrow_schema(columns: str) -> pa.Schema:
    """Arrow schema of ``name type, ...``, for use inside tasks."""
    return pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in columns.split(", "))])


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(cols, schema, strict=True)], schema=schema)
