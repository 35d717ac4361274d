"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the job relies on.  AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions of sort-merge joins (a hot person_id or
# a hot lookup bucket).
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "anthro", extra: dict | None = None) -> SparkSession:
    """Return a session with the job settings.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    (tests, bench) pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(JOB_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Called lazily, only by code that writes scratch data (round-trip check,
    stream output and checkpoints); the batch job itself needs none.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is
    unset *and* Spark runs in local mode (tests, bench) a scratch folder is
    created and set; on a cluster an unset value is an error, since a
    machine-local folder does not survive the loss of that machine.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running the z-score job on a cluster")
    d = tempfile.mkdtemp(prefix="anthro-ckpt-")
    sc.setCheckpointDir(d)
    try:
        spark.conf.set("spark.checkpoint.dir", d)
    except Exception:  # a session may refuse to change a core setting; the context has it
        pass
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for local file checks in tests."""
    return p[5:] if p.startswith("file:") else p


__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path", "JOB_CONF", "local_path"]
