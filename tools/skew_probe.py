"""One person with a third of all measurements, person join forced to a
sort-merge join (as at scale): no skew handling vs AQE skew split vs the
explicit salted split.  Reads an R-fold order table written by
scale_probe.py.  Prints one JSON line per mode.

    python tools/skew_probe.py <orders_parquet_dir> [sf_dir]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from anthro.plans.zscore_job import bmi_zscore  # noqa: E402
from anthro.session import get_session  # noqa: E402
from anthro.sources.fixtures import measurement_from_orders, person_from_customer  # noqa: E402
from anthro.sources.grids import rule_grid  # noqa: E402


def main() -> None:
    path = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    m = measurement_from_orders(spark.read.parquet(path))
    m = m.withColumn("person_id", F.when(F.col("measurement_id") % 3 == 0, F.lit(4))
                     .otherwise(F.col("person_id")))
    person = person_from_customer(spark.read.parquet(f"{sf_dir}/customer.parquet"))
    modes = {
        "no_skew_handling": ({"spark.sql.adaptive.skewJoin.enabled": "false"}, {}),
        "aqe_skew_split": ({"spark.sql.adaptive.skewJoin.enabled": "true",
                            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4MB",
                            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4MB"}, {}),
        "salted_hot_keys": ({"spark.sql.adaptive.skewJoin.enabled": "false"},
                            {"hot_key_fraction": 0.1}),
    }
    ref = None
    for name, (conf, kw) in modes.items():
        for k, v in conf.items():
            spark.conf.set(k, v)

        def once():
            t0 = time.perf_counter()
            bmi_zscore(m, person, rule_grid(spark), **kw).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()
        sec = statistics.median(once() for _ in range(3))
        n = bmi_zscore(m, person, rule_grid(spark), **kw).count()
        ref = ref if ref is not None else n
        print(json.dumps({"mode": name, "rows_out": n, "same_rows": n == ref, "sec": round(sec, 3)}),
              flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
