"""Benchmark the headline queries.

Runs the headline queries (one or more per query family; BENCH_QUERIES=all
for every registered query, or a comma list) over the tables in
$BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line:
{"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is fully materialised with a no-op write, so the timing covers
the whole plan rather than a sample of rows.  One untimed warm-up query
starts the JVM's code generation first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans import registry  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(cpus=cpus, app_name="ledgerlens-bench")
    qs = registry.queries()
    which = os.environ.get("BENCH_QUERIES", "headline")
    names = registry.headline() if which == "headline" else sorted(qs)
    if which not in ("all", "headline"):
        names = [n for n in which.split(",") if n in qs]
    # untimed warm-up: JIT and code generation of the first plan
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).groupBy("r_name").count().collect()
    timings = {}
    failed = {}
    for name in names:
        t0 = time.time()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.time() - t0, 3)
        except Exception as exc:  # keep benchmarking the rest
            failed[name] = str(exc)[:200]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "n_queries": len(timings),
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
