"""Benchmark of the headline operators.

Inputs (concepts, ledger, drafts, request table, answers, embeddings, texts)
are first written to Parquet in a fresh scratch folder, as a production run
reads them from storage; then each operator reads them and runs to completion
into Spark's ``noop`` sink. Prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (timed runs after one warm-up, median reported; default 1),
     BENCH_ONLY (comma-separated query names).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from seedmill.session import ensure_checkpoint_dir, get_session  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    only = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="seedmill-bench")
    ensure_checkpoint_dir(spark)
    scratch = tempfile.mkdtemp(prefix="seedmill-bench-")

    from seedmill.plans import bench_plans as bp
    inputs = bp.materialize_inputs(spark, sf_dir, scratch)
    plans = bp.headline(spark, inputs)

    times = {}
    for name, fn in plans.items():
        if only and name not in only:
            continue
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            out = fn()
            if out is not None:
                out.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0 or repeat == 0:
                runs.append(dt)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
