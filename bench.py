"""Benchmark: headline queries on ``$BENCH_SF_DIR`` (default sf0.1) on
``local[$BENCH_CPUS]``; each query is planned and written to the ``noop``
sink, ``$BENCH_WARMUP`` warm-up runs then the median of ``$BENCH_RUNS`` runs.
Prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "report_load", "report_load_files", "report_load_quarter", "unpivot_month", "unpivot_quarter", "label_split",
    "metric_lookup", "time_join", "final_layout", "section_carve", "preamble", "value_parse",
    "upsert", "merge_key_dups",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    # the JVM compiles the generated code over the first runs of a query
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    names = sys.argv[1:] or HEADLINE
    from tallyspark.session import get_spark, shared_dir
    from tallyspark.plans.queries import QUERIES
    spark = get_spark(f"local[{cpus}]", "tallyspark-bench", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    shared_dir(spark)
    per_query = {}
    for name in names:
        fn = QUERIES[name]
        times = []
        for i in range(warmup + runs):
            t = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i >= warmup:
                times.append(time.perf_counter() - t)
        per_query[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "shuffle_partitions": cpus * 2,
        "runs": runs,
        "warmup_runs": warmup,
        "sink": "noop",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
