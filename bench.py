"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "user_product_features",
    "user_profiles",
    "product_catalog",
    "user_interactions",
    "transaction_history",
    "product_reviews",
    "search_logs",
    "dedup_by_key",
    "pair_counts",
    "matrix_stats",
    "id_encode",
    "topk_per_user",
    "recs_with_metadata",
    "serve_requests",
    "stratified_split",
    "tfidf",
    "roc_auc",
    "ndcg_at_k",
    "als_implicit",
    "recommend_all",
    "search_rank",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = sys.argv[1:] or HEADLINE

    from pasarlens.registry import all_queries
    from pasarlens.session import build_session, clear_staging

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    builds = {q.name: q.build for q in all_queries()}

    def once(name: str) -> float:
        started = time.perf_counter()
        builds[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    once("user_product_features")  # start-up of the JVM is not measured
    times = {name: round(statistics.median(once(name) for _ in range(runs)), 3) for name in chosen}
    clear_staging(spark)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder),
            }
        )
    )


if __name__ == "__main__":
    main()
