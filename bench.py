"""Times headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "ctr_daily",
    "ctr_by_tag",
    "most_popular_by_dim",
    "weighted_ratings",
    "users_by_dim",
    "tag_affinity",
    "rec_recency",
    "cluster_top_counts",
    "significant_counts",
    "session_items",
    "basket_sessions",
    "engagement_ab",
    "history_features",
    "item_cosine",
    "item_cooccurrence",
    "fp_rules",
    "edge_triangles",
    "vector_neighbours",
    "tag_knn",
    "ngram_next",
    "tfidf_features",
    "rec_item_sim",
    "rec_cluster_counts",
    "rec_popular",
    "ensemble",
    "eval_ranking",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tidewell.plans import catalog
    from tidewell.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(cpus, 8), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    catalog.QUERIES["ctr_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
