"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query runs once to warm up and then three times; the median counts.  Results
go to a sink that takes every row, so nothing is optimised away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from marquee.plans.bindings import BATCH  # noqa: E402
from marquee.plans.file_bindings import FILES  # noqa: E402
from marquee.session import local_session  # noqa: E402

QUERIES = {**BATCH, **FILES}
HEADLINE = (
    "all_five_from_files", "q1_coproduction_genres", "q2_top_solo", "q2_by_tenant", "q3_rating_extremes",
    "q4_top_actors", "q5_sentiment_rates", "clean_movies", "join_ratings",
    "join_credits_semi", "agg_avg_rating", "dedup_messages", "route_sentiment", "rank_titles",
    "decode_movies", "decode_credits", "read_movies_multiline", "read_documents", "inspect_json",
    "polarity_rules", "range_join",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, memory="16g")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in names:
        seconds(name)
        timings[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
