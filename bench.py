"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores. Each
query is run once to warm up and then timed in full: every column of every row is produced.
"""

from __future__ import annotations

import json
import os
import time

from marquee.plans.registered import QUERIES
from marquee.session import build_session

HEADLINE = [
    "group_stats_by_genre", "group_stats_by_company", "clean_catalog", "dim_from_list", "bridge_from_list",
    "enriched_view18", "null_report", "describe", "correlation_matrix", "iqr_filter", "value_counts_list",
    "word_count", "tfidf_weights", "similar_by_title", "cosine_topk", "vector_knn", "recommend_listing",
    "user_split", "auc_from_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings: dict[str, float] = {}
    for name in HEADLINE:
        run(name)
        timings[name] = round(run(name), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
