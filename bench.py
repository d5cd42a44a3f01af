"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set input and cores.
Each time is the best of three runs into a sink that keeps nothing, after a warm-up. The
one-time writes that composite models share are timed on their own as `stage_tables` and
`publish_exports`. `lazy` has composite models once from raw rows, which is not part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wardline.context import build_session  # noqa: E402
from wardline.plans.registry import all_queries  # noqa: E402
from wardline.plans.star import Star, published_exports, stored_star  # noqa: E402

HEADLINE = (
    "dedup_latest",
    "stg_complaints",
    "stg_permits",
    "stg_inspections",
    "stg_arrests",
    "point_in_polygon",
    "monthly_complaints",
    "monthly_arrests",
    "monthly_permits",
    "monthly_inspections",
    "mart_top_types",
    "mart_safety_full_outer",
    "mart_food_full_outer",
    "fact_monthly",
    "mart_pulse_wide",
    "kpi_pulse_summary",
    "kpi_borough_trends",
    "lag_join",
    "zip_seed",
    "upsert_merge",
    "scd2_history",
    "dq_results",
    "q01_zip_month",
    "q05_score_distribution",
    "q15_permit_ratio_matrix",
    "q18_compliance_scatter",
)


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus), **{"spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> None:
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()

    run("mart_top_types")
    seconds = {
        "stage_tables": timed(lambda: stored_star(spark, folder)),
        "publish_exports": timed(lambda: published_exports(spark, folder)),
    }
    for name in HEADLINE:
        seconds[name] = min(timed(lambda: run(name)) for _ in range(3))
    # The composite models from raw rows to result, beside their times over stored tables above.
    star = Star(spark, folder)
    lazy = {
        name: timed(lambda: build().write.format("noop").mode("overwrite").save())
        for name, build in (
            ("fact_monthly", lambda: star.fact),
            ("mart_pulse_wide", lambda: star.pulse),
            ("mart_safety_full_outer", lambda: star.safety),
            ("mart_food_full_outer", lambda: star.food),
            ("kpi_pulse_summary", lambda: star.lazy_exports["neighborhood_pulse_summary"]),
            ("lag_join", lambda: star.lags),
        )
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in seconds.items()},
                "lazy": {n: round(s, 3) for n, s in lazy.items()},
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
