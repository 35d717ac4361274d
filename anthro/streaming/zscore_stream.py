"""The z-score job on a stream of measurement files (Structured Streaming).

New measurement files are picked up incrementally; each micro-batch joins
the static person table and the broadcast bracket table (stream-static
joins, no state) and appends z-score records to a file sink partitioned by
site.  The checkpoint and the output live below the session's shared
``spark.checkpoint.dir``, so a restarted query resumes where it stopped
and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from anthro.constants import DAYS_PER_MONTH
from anthro.operators.day_table import build_day_table
from anthro.plans.zscore_job import bmi_zscore
from anthro.session import scratch_path
from anthro.sources.fixtures import measurement_from_orders, person_from_customer, read_table
from anthro.sources.grids import rule_grid
from anthro.sources.sinks import read_zscores


def start_zscore_stream(measurement: DataFrame, person: DataFrame, grid, out_path: str,
                        checkpoint: str, *, available_now: bool = True,
                        processing_time: str | None = None, **job_opts) -> StreamingQuery:
    """Start the job on a streaming ``measurement`` DataFrame.

    ``grid`` may be a grid or a prebuilt lookup table (``DayTable`` or
    ``Brackets``), built once and reused by every micro-batch.
    """
    if not measurement.isStreaming:
        raise ValueError("measurement must be a streaming DataFrame")
    records = bmi_zscore(measurement, person, grid, **job_opts)
    w = (records.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("site_id"))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start(out_path)


def run_zscore_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None, *,
                      orders_dir: str | None = None, glob: str = "orders*.parquet",
                      out: str | None = None, checkpoint: str | None = None,
                      **job_opts) -> DataFrame:
    """Stream order files through the job until no new file is left; return
    the written records (read back from the sink).

    By default the order file of ``sf_dir`` is streamed into fresh folders.
    Pass ``orders_dir``/``out``/``checkpoint`` to resume an earlier run: only
    files that arrived since are processed, and the sink's log keeps each
    file's rows exactly once.  ``max_files_per_trigger`` bounds a micro-batch
    (default: all files that wait, so work runs over them in parallel).
    """
    src = (orders_dir or sf_dir).rstrip("/")
    schema = read_table(spark, sf_dir, "orders").schema
    # A file stream source watches a folder; the glob keeps the order files.
    stream = (spark.readStream.schema(schema)
              .option("pathGlobFilter", glob))
    if max_files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = stream.parquet(src)
    person = person_from_customer(read_table(spark, sf_dir, "customer"))
    grid = rule_grid(spark)
    table = build_day_table(grid, k=job_opts.get("neighbor_rank", 1),
                            days_per_month=job_opts.get("days_per_month", DAYS_PER_MONTH))
    out = out or scratch_path(spark, "zscore-stream-out")
    checkpoint = checkpoint or scratch_path(spark, "zscore-stream-ckpt")
    q = start_zscore_stream(measurement_from_orders(stream), person, table, out, checkpoint,
                            **job_opts)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return read_zscores(spark, out)


__all__ = ["run_zscore_stream", "start_zscore_stream"]
