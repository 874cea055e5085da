"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full through the ``noop`` sink (every row computed,
nothing gathered on the driver).  ``BENCH_QUERIES`` (comma list) overrides the
headline set; ``BENCH_REPEAT`` repeats each query and keeps the best time.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["cf_predict", "pair_weight", "feature_rows", "gbt_predict", "hybrid_predict"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))

    from tastebud.plans import catalog
    from tastebud.session import build_session, checkpoint_dir

    n_cpu = int(cpus) if cpus.isdigit() else os.cpu_count() or 8
    spark = build_session(
        f"local[{cpus}]", app="tastebud-bench", shuffle_partitions=max(8, 4 * n_cpu),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
               "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
               "spark.ui.showConsoleProgress": "false",
               # TCP between JVM and Python workers costs a delayed acknowledgement (40 ms) a task
               "spark.python.unix.domain.socket.enabled": "true",
               # local[N] has few cores: smaller AQE targets give more, evener tasks
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": os.environ.get(
                   "BENCH_ADVISORY_BYTES", str(16 * 1024 * 1024)),
               # more, smaller files for the tables written mid-plan on few cores
               "tastebud.materialize.maxRecordsPerFile": os.environ.get(
                   "BENCH_MAX_RECORDS_PER_FILE", "100000")})
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)

    qs = catalog.queries()
    # untimed JVM/JIT warm-up on the smallest tables (BENCH_WARMUP="" disables)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for name in [q for q in os.environ.get("BENCH_WARMUP", "cf_predict").split(",") if q]:
        if name in qs and os.path.isdir(warm_dir):
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        if name not in qs:
            continue
        best = None
        for _ in range(repeat):
            t0 = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.time() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
