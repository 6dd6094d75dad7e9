"""Times the registered headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from loomwork.plans import registry
from loomwork.session import session

HEADLINE = [
    "exact_dedup", "pairs_from_groups", "grid_block_house", "combine_blocks_1km", "name_block_jaro", "knn_cosine_topk", "clean_text", "remove_stop_words", "category_mode", "jaro_leven",
    "dice_bigram", "match_codes", "pair_features", "threshold_sweep", "rule_crosstab", "connected_components",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus, int(cpus) if cpus.isdigit() else 8, memory="12g")
    queries, took = registry.queries(), {}
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    for name in names:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0)}))


if __name__ == "__main__":
    main()
