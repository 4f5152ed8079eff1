"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankloom.plans.catalog import QUERIES  # noqa: E402
from rankloom.session import build_session  # noqa: E402

HEADLINE = [
    "g5_rank_resumes",
    "flow_score_and_rank",
    "g8_borda_ranking",
    "e1_clean_text",
    "d3_tfidf_cosine",
    "e5_tfidf",
    "d4_ngram_jaccard",
    "k2_dedupe_keep_first",
    "c5_unordered_pairs",
    "g11_bradley_terry_3_steps",
    "h12_mean_average_precision",
    "d5_nearest_neighbours",
    "l5_pair_classifier",
    "m2_first_arrivals",
]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session("rankloom-bench", master=f"local[{cpus}]", partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{d}/nation.parquet").count()  # start-up is not part of a query
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    sf = os.path.basename(d.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
