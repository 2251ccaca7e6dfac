"""Wall time of every query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from docweave.session import build_session
from workload.queries import QUERIES

# Times of a run that failed are left out of `queries` and named in `failed`.


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark_ui_enabled="false", spark_driver_memory="20g",
        spark_sql_shuffle_partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("dataset_match", "attribute_rows"):  # warm the JVM
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name, query in QUERIES.items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as error:  # a failing query must not hide the others
            failed[name] = str(error)[:200]
            continue
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    report = {
        "metric": "total wall time of all queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "failed": failed,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main(sys.argv[1:])
