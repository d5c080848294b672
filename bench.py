"""Headline-query benchmark.

Runs the headline operator queries over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is fully executed into the ``noop`` sink (every row produced, none
collected), after one untimed warm-up pass of the whole set so JVM start-up
and code generation are not charged to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hearth.plans.testbed import QUERIES  # noqa: E402
from hearth.session import get_session  # noqa: E402

HEADLINE = ["rp2", "rp6", "a4", "a5", "a6", "a19", "w1", "w5", "w6", "w8", "j8", "j10", "j11", "j11_orders",
            "j12_asof", "j14", "j15", "u3", "d_date", "x_event", "f1", "x1",
            # warehouse jobs over the EMR source derived from the same tables
            "emr_obs", "emr_state", "emr_urgent_visits", "emr_last_obs",
            # the slowest ones
            "emr_fact_event", "emr_fact_numeric", "emr_dim_date", "emr_active_cohort", "emr_latest_per_period"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="hearth-bench",
                        driver_memory="12g")
    names = [n for n in HEADLINE if n in QUERIES]

    for n in names:   # warm-up
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
