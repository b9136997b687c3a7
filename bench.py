"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is forced to completion with the ``noop`` sink (every column computed, nothing collected) and run
$BENCH_RUNS times (default 2); the best run is reported (warm JVM and JIT), the first run's time is kept in
``cold`` for reference.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from playledger.plans.catalog import load_all  # noqa: E402
from playledger.session import configure_for_scale, get_session, input_bytes  # noqa: E402

HEADLINE = ["budget_allocation", "panel_day_health", "hourly_rollup_keepnull", "hourly_rollup_dropnull",
            "job_fact_play_logs", "job_logs_enriched", "period_bridge", "coverage",
            "job_campaign_full", "log_last_run"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    configure_for_scale(spark, input_bytes([sf_dir]), cpus)
    qs = load_all()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times, cold = {}, {}
    # warm-up: JVM start, parquet footers
    qs[names[0]][0](spark, sf_dir).limit(1).collect()
    for n in names:
        ts = []
        for _ in range(runs):
            t0 = time.time()
            qs[n][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
            ts.append(time.time() - t0)
        times[n] = round(min(ts), 3)
        cold[n] = round(ts[0], 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs, "cold": cold,
                      "cold_total": round(sum(cold.values()), 3)}))


if __name__ == "__main__":
    main()
