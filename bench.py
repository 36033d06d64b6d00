"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_RUNS    timed runs per query after an untimed one, the median counts (default 1)

``rows_per_sec`` relates whole input tables to the time of queries that read each of their rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from pathlark.session import build_session  # noqa: E402

HEADLINE = [
    "clean_valid", "clean_stats", "user_features_orders", "item_features_orders", "user_high_freq_category_orders",
    "behavior_funnel_orders", "win_sliding_features", "win_sliding_features_day", "hot_items_two_phase",
    "hot_items_two_phase_orders", "agg_training_samples_orders", "score_tree_ensemble", "score_tree_ensemble_50x3", "score_tree_ensemble_100x5", "topk_per_user",
    "topk_per_user_orders", "serving_top50", "ctr_cvr_after_rec_orders", "pr_auc_average_precision",
    "evaluate_offline", "downsample_negatives", "train_test_split", "sink_upsert_recommendations",
    "stream_land_behavior", "stream_win_sliding_features", "stream_topk",
]

READS = {
    "user_features_orders": "lineitem", "item_features_orders": "lineitem", "agg_training_samples_orders": "lineitem",
    "topk_per_user_orders": "lineitem", "hot_items_two_phase_orders": "lineitem", "win_sliding_features": "events",
    "stream_land_behavior": "events", "stream_win_sliding_features": "events", "stream_topk": "events",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", max(cpus, 8), **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()  # start-up

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in set(READS.values())}
    times = {}
    for name in names:
        once(name)  # compiles its code
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows_per_sec": {n: round(sizes[READS[n]] / times[n]) for n in names if n in READS},
        "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus, "runs": runs,
    }))


if __name__ == "__main__":
    main()
