"""Times of the headline queries, as one JSON line.

Each query is run once to warm up and then timed, from building the query to
having every row of its result. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the
tables and the cores.
"""

from __future__ import annotations

import json
import os
import time

from spendgroups.plans.queries import QUERIES
from spendgroups.session import local_session

HEADLINE = (
    "csv_scan saved_list_round_trip lookup_by_id lookup_by_position default_values "
    "range_warnings cast_ok customer_strategy null_nan_counts row_and_duplicate_count "
    "describe_numeric correlation_matrix table_overview hist20 hist_auto density_curve "
    "box_stats box_outliers box_by_group count_by_group points_by_gender standardize "
    "assign_to_given_centres elbow_k5_cost elbow_sweep_all group_report profile_report "
    "model_round_trip model_registry score_batch"
).split()


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    times = {}
    for name in HEADLINE:
        timed(spark, folder, name)
        times[name] = round(timed(spark, folder, name), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
