"""Per-query jobs, stages, tasks, input and shuffle bytes, from Spark's
event log (written to a fresh scratch folder; no UI, no server).

    python tools/stage_report.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from anthro.queries import QUERIES  # noqa: E402
from anthro.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(QUERIES)
    logdir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = get_session("local[8]", 16, extra={"spark.eventLog.enabled": "true",
                                               "spark.eventLog.compress": "false",
                                               "spark.eventLog.dir": logdir})
    sc = spark.sparkContext
    for name in names:
        sc.setJobDescription(name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    sc.setJobDescription(None)
    spark.stop()

    job_query, stage_job = {}, {}
    per = defaultdict(lambda: {"jobs": 0, "stages": set(), "tasks": 0, "input_mb": 0.0,
                               "shuffle_write_mb": 0.0, "max_task_ms": 0})
    for path in sorted(glob.glob(f"{logdir}/**/*", recursive=True)):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    q = (ev.get("Properties") or {}).get("spark.job.description")
                    if q in QUERIES:
                        job_query[ev["Job ID"]] = q
                        per[q]["jobs"] += 1
                        for sid in ev.get("Stage IDs", []):
                            stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    q = job_query.get(stage_job.get(ev["Stage ID"]))
                    if q is None:
                        continue
                    m = ev.get("Task Metrics") or {}
                    r = per[q]
                    r["stages"].add(ev["Stage ID"])
                    r["tasks"] += 1
                    r["input_mb"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0) / 2**20
                    r["shuffle_write_mb"] += (m.get("Shuffle Write Metrics") or {}).get(
                        "Shuffle Bytes Written", 0) / 2**20
                    r["max_task_ms"] = max(r["max_task_ms"], m.get("Executor Run Time", 0))
    for name in names:
        r = per[name]
        print(json.dumps({"query": name, "jobs": r["jobs"], "stages": len(r["stages"]),
                          "tasks": r["tasks"], "input_mb": round(r["input_mb"], 2),
                          "shuffle_write_mb": round(r["shuffle_write_mb"], 3),
                          "max_task_ms": r["max_task_ms"]}))


if __name__ == "__main__":
    main()
