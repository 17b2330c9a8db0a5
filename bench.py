"""Time the headline queries and print one JSON line."""

import json
import os
import time
from pathlib import Path

from tallyweave.registry import QUERIES
from tallyweave.session import local_session

HEADLINE = [
    "top_states",
    "exploration_report",
    "partition_profile_keyed",
    "itemsets_frequent",
    "itemsets_by_user",
    "son_itemsets",
    "pcy_itemsets",
    "lsh_candidates",
    "similar_pairs",
    "exact_jaccard_pairs",
    "lsh_precision_recall",
    "item_profiles",
    "user_profiles",
    "content_scores",
    "item_pearson",
    "rating_predictions",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="tallyweave-bench")
    # Start-up and class loading are not part of any query.
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_custkey").count().write.format("noop").mode(
        "overwrite"
    ).save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
