"""Wall seconds of the headline jobs at one scale, as a single JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from filmloom.session import build_session  # noqa: E402
from filmloom.workload import QUERIES  # noqa: E402

HEADLINE = [
    "build_final",
    "explode_cast",
    "check_foreign_keys",
    "check_constraints",
    "split_per_user",
    "top_k_per_user",
    "upsert_ratings",
    "tfidf_items",
    "score_all_pairs",
    "exact_knn",
    "recommend_popular",
    "recommend_tfidf",
    "recommend_cold_start",
    "recommend_genre_overlap",
    "recommend_fold_in",
    "recommend_hybrid",
    "recommend_routed",
    "segment_metrics",
    "run_comparison",
    "user_auc",
    "propagate",
    "sample_negatives",
    "train_svd",
    "train_warp",
    "train_graph_bpr",
    "train_explicit_mf",
    "stream_user_stage",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        app_name="bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy().count().collect()
    seconds, failed = {}, {}
    for name in names:
        start = time.perf_counter()
        try:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # noqa: BLE001
            failed[name] = str(error)[:200]
        print(name, seconds.get(name, "failed"), file=sys.stderr, flush=True)
    line = {
        "metric": "headline jobs, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if failed:
        line["failed"] = failed
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
