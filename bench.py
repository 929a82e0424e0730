"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the input directory, BENCH_CPUS the number of local threads.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwise.plans.registry import all_queries  # noqa: E402
from tillwise.session import local_session  # noqa: E402

HEADLINE = [
    "div_annual_leaderboard", "eda_monthly_sales", "eda_top_divisions_year", "eda_cold_snap_effect",
    "eda_customer_segments", "win_rolling_7_28", "win_weekly_rank", "win_cum_share", "win_percentiles",
    "div_share_of_store", "dept_monthly_share", "top_skus", "rfm_segments", "rfm_temp_crosstab",
    "prep_basket_rollup", "prep_items_with_date", "prep_stock_ledger", "build_features",
    "fc_walk_forward_log", "fc_walk_forward_regression", "fc_bias_flags", "fc_gbt_point",
    "kmeans_segments", "dash_scenario_rows",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, partitions=2 * cpus)
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, directory).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("eda_dow_profile")  # start-up and code loading stay out of the figures
    seconds = {}
    for name in chosen:
        seconds[name] = round(run(name), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
