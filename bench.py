"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full with the no-op sink (no driver collect), after
one warm-up query.  ``value`` is the sum of per-query seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "v2_evaluate",            # flagship: exact + binned AUC, all splits and tasks
    "a5_auc_exact",
    "a6_auc_per_class",
    "w3_batch_number",
    "j3_alignment_audit",
    "a1_variable_stats",
    "a2_stats_wide",
    "p3_assemble_features",
    "e3_los_bucket",
    "e5_activations",
    "s3_read_sequences",
    "v1_predict",
    "m5_fit_multitask",       # 20 epochs, shared 750-unit trunk, three heads
    "v4_final_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from orrery.plans.catalog import QUERIES
    from orrery.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                      extra={"spark.driver.memory": "16g"})
    QUERIES["j1_align"](spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
