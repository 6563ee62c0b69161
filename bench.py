"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from lodestone.plans import catalogue
from lodestone.session import get_session

HEADLINE = ["bm25_topk", "dense_topk", "rrf_hybrid", "hybrid_retrieve", "url_canonical", "page_links", "parse_pages", "chunk_windows", "content_dedup", "verify_gate"]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_session("lodestone-bench", cores=os.environ.get("BENCH_CPUS", "8"), shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    todo = catalogue.queries()
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS + 1):  # the first warms up
            start = time.time()
            todo[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        took[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
