"""Throughput of the flagship job as the input grows.

Derives R-fold order tables from the driver's ``orders`` with Spark
(replica r gets keys ``o_orderkey + r * 10**7``, same customers, so each
person has R times the measurements), writes each once as many parquet
files below a scratch folder, and times ``bmi_zscore`` through the noop
sink (median of 3).  Prints one JSON line per size.

    python tools/scale_probe.py [sf_dir] [R ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from anthro.plans.zscore_job import bmi_zscore  # noqa: E402
from anthro.session import get_session  # noqa: E402
from anthro.sources.fixtures import measurement_from_orders, person_from_customer  # noqa: E402
from anthro.sources.grids import rule_grid  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    sizes = [int(a) for a in sys.argv[2:]] or [1, 10, 40]
    spark = get_session("local[8]", 16)
    scratch = tempfile.mkdtemp(prefix="run-scale-", dir="/tmp")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    person = person_from_customer(spark.read.parquet(f"{sf_dir}/customer.parquet"))
    for r in sizes:
        path = f"{scratch}/orders_x{r}"
        (orders.withColumn("__r", F.explode(F.sequence(F.lit(0), F.lit(r - 1))))
         .withColumn("o_orderkey", F.col("o_orderkey") + F.col("__r") * F.lit(10 ** 7))
         .drop("__r").repartition(max(8, 2 * r)).write.parquet(path))
        m = measurement_from_orders(spark.read.parquet(path))
        n_in = spark.read.parquet(path).count()

        def once():
            t0 = time.perf_counter()
            bmi_zscore(m, person, rule_grid(spark)).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()
        sec = statistics.median(once() for _ in range(3))
        n_out = bmi_zscore(m, person, rule_grid(spark)).count()
        print(json.dumps({"replicas": r, "rows_in": n_in, "rows_out": n_out,
                          "sec": round(sec, 3), "rows_per_sec": round(n_in / sec)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
