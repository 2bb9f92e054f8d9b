"""Benchmark the headline queries; prints ONE JSON line on stdout.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPS (default 5). Each query: one warm-up, then the median of the
timed runs. Results are forced with the ``noop`` sink, so the whole plan
runs on the executors and nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))

    from farespark.params import DEFAULT
    from farespark.plans import flows, models
    from farespark.plans import pipeline as PL
    from farespark.plans.registry import REGISTRY
    from farespark.session import get_spark, scratch_path
    from farespark.sources import variants as V
    from farespark.schemas import RAW

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus, extra={"spark.driver.memory": "16g"})

    def run_query(name):
        def go():
            REGISTRY[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()

        return go

    def run_pipeline():
        layout = PL.Layout(scratch_path(spark, "bench-pipeline"))
        cols = RAW.fieldNames()
        for b in (V.batch1(spark, sf_dir), V.batch2(spark, sf_dir)):
            PL.run_batch(spark, b.select(*cols), layout, flows.RUN_TS, DEFAULT)

    def run_ods():
        models.ods(models.stg(flows.fx1_stg_base(spark, sf_dir))).write.format("noop").mode("overwrite").save()

    cases = {
        "model_ods": run_ods,
        "model_dwh": run_query("model_dwh"),
        "model_dm": run_query("model_dm"),
        "model_dm_fx2": run_query("model_dm_fx2"),
        "dq_all_columns": run_query("dq_all_columns"),
        "dq_report": run_query("dq_report"),
        "pipeline_incremental": run_pipeline,
    }
    results = {}
    for name, fn in cases.items():
        fn()  # warm-up
        times = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
        print(f"{name}: {results[name]}s {[round(t, 3) for t in times]}", file=sys.stderr, flush=True)

    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "reps": reps,
        "shuffle_partitions": cpus,
    }
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
