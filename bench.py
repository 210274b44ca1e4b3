"""Headline queries on local cores; prints one JSON line.

The raw feeds are landed before timing, as the pipelines start from landed files. Every query is
run once to warm up and then timed three times; the median counts, the result is computed and thrown away.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries as Q  # noqa: E402
from checks.feeds import FEEDS, feed  # noqa: E402
from quotebridge.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "internal_quotes", "exchange_quotes", "assessor_quotes", "daily_report", "reconcile",
    "merge_newer_wins", "inconsistent_detail", "duplicate_flags", "generic_standard",
    "match_stats_by_date", "internal_extract", "missing_feeds",
]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    Q.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(memory="16g")
    for name in FEEDS:
        feed(spark, SF_DIR, name)
    for table in (Q.internal_table, Q.exchange_table, Q.assessor_table):
        table(spark, SF_DIR)
    seconds = {}
    for name in HEADLINE:
        run(spark, name)
        seconds[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
