"""Run queries under local[1] and local[4] (separate processes) and compare results.

Results must not depend on the number of cores: partitioning, range bounds
and shard placement change, the answers must not.  Training depends on
(K, seed) only, so its per-epoch metrics must agree too (to 1e-6 here).

Usage: python tools/cores_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import json
import math
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DEFAULT = ["v2_evaluate", "a6_auc_per_class", "w3_batch_number", "a1_variable_stats", "s3_read_sequences",
           "j3_alignment_audit", "m5_fit_multitask"]


def run_child(cores: int, sf: str, names: list[str], out: str) -> None:
    sys.path.insert(0, ROOT)
    from orrery.plans.catalog import QUERIES
    from orrery.session import get_spark
    spark = get_spark(f"local[{cores}]", shuffle_partitions=2 * cores)
    res = {}
    for n in names:
        df = QUERIES[n](spark, sf)
        rows = [[(round(v, 6) if isinstance(v, float) and not math.isnan(v) else v) for v in r]
                for r in df.collect()]
        res[n] = {"cols": df.columns, "rows": sorted(rows, key=lambda r: json.dumps(r, default=str))}
    with open(out, "w") as f:
        json.dump(res, f, default=str)
    spark.stop()


def main() -> None:
    if len(sys.argv) > 1 and sys.argv[1] == "--child":
        run_child(int(sys.argv[2]), sys.argv[3], sys.argv[5:], sys.argv[4])
        return
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or DEFAULT
    d = tempfile.mkdtemp(prefix="cores-")
    outs = {}
    for cores in (1, 4):
        outs[cores] = os.path.join(d, f"c{cores}.json")
        subprocess.run([sys.executable, os.path.abspath(__file__), "--child", str(cores), sf, outs[cores], *names],
                       check=True, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    a, b = (json.load(open(outs[c])) for c in (1, 4))
    bad = 0
    for n in names:
        same = a[n] == b[n]
        if not same and a[n]["cols"] == b[n]["cols"] and len(a[n]["rows"]) == len(b[n]["rows"]):
            same = all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 2e-6)
                       for ra, rb in zip(a[n]["rows"], b[n]["rows"]) for x, y in zip(ra, rb))
        print(f"{n:28s} {'SAME' if same else 'DIFFERENT'} rows={len(a[n]['rows'])}")
        bad += not same
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
