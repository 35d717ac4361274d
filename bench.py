"""Benchmark the headline queries; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every column of
every row is computed; ``count()`` would let Catalyst prune the z-score
away).  One untimed pass over all headline queries comes first (the JVM
JIT-compiles Spark's planner on the first few queries, which otherwise
lands on whichever query is timed first); then each query reports the
median of ``BENCH_RUNS`` (default 3) runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from anthro.queries import QUERIES  # noqa: E402
from anthro.session import get_session  # noqa: E402

HEADLINE = (
    "bmi_zscore",
    "bmi_zscore_literal",
    "bmi_zscore_bracket",
    "measurement_cohort",
    "bracket_lookup",
    "bracket_lookup_rank2",
    "bracket_lookup_salted",
    "lms_zscore",
    "zscore_strict",
    "zscore_by_site",
    "zscore_hot_key_split",
    "write_roundtrip",
    "zscore_stream",
)


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    failed = {}
    for name in HEADLINE:  # warm-up pass
        try:
            _run(spark, name, sf_dir)
        except Exception as exc:  # report it, keep the other numbers
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    times = {}
    for name in HEADLINE:
        if name in failed:
            times[name] = None
            continue
        try:
            times[name] = round(statistics.median(_run(spark, name, sf_dir) for _ in range(runs)), 3)
        except Exception as exc:
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            times[name] = None
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_headline_query_time",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        **({"failed": failed} if failed else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
