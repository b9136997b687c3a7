"""Run the headline queries and write the plans that ran (after adaptive re-planning) to docs/plans/.

usage: python tools/dump_plans.py [sf_dir]
"""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from playledger.plans.catalog import load_all  # noqa: E402
from playledger.session import get_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out_dir = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    spark = get_session("local[8]", 16)
    qs = load_all()
    for name in bench.HEADLINE + ["daily_fact_health"]:
        df = qs[name][0](spark, sf)
        run = df._jdf.queryExecution()
        run.toRdd().count()  # the very plan printed below
        plan = run.executedPlan().toString()
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(f"-- {name} at {sf}, as executed\n{plan}")
        print(name, len(plan))


if __name__ == "__main__":
    main()
