"""Time every registered query and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS
(default 3) steer it. Batch queries run once to warm up and then BENCH_RUNS times,
or once more if the warm-up took over LONG seconds; their number is the median.
Queries that run a stream or write a table start from
an empty folder every time and are timed once, after the warm-up of all others.
`noop` writes make every row be computed and none be collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemart.plans.queries import QUERIES
from tidemart.session import build_session

# These do their work while the query is built: streams, sinks and topics.
EAGER = (
    "topic_sink",
    "topic_sink_keyed",
    "topic_source",
    "daily_index_dau",
    "daily_index_orders",
    "replay_idempotent",
    "raw_log_archive",
    "order_wide_store",
    "dau_stream",
    "dau_stream_dedupe",
    "first_order_stream",
    "first_order_job",
    "order_wide_stream",
    "order_wide_buffered",
    "pair_dedupe_stream",
    "resume_from_checkpoint",
    "order_wide_outer_stream",
    "detail_amount_stream",
    "pair_dedupe_renewed",
    "stored_offsets",
    "topic_rejects",
    "late_rows",
    "dimension_job",
    "dau_total_day",
    "order_total_day",
    "order_hour_day",
    "sale_detail_day",
    "dau_rollup",
    "order_rollup",
    "search_deep_page",
)


LONG = 3.0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session("tidemart-bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in sorted(names, key=lambda n: n in EAGER):
        if name in EAGER:
            seconds[name] = once(name)
        else:
            repeats = runs if once(name) < LONG else 1
            seconds[name] = statistics.median(once(name) for _ in range(repeats))
        print(f"{name:28s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)

    print(
        json.dumps(
            {
                "metric": "total seconds, one run of every query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds[name], 4) for name in names},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "pyspark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
