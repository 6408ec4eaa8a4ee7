"""Times the headline queries and prints one JSON line.

Every query's full result is computed and thrown away; nothing is cached in between. Each
query runs once on the smallest tables first, so that times are not those of class loading.
"""

from __future__ import annotations

import json
import os
import time

from clickflow.plans.catalog import all_queries
from clickflow.session import build_session

HEADLINE = [
    "channel_pvuv", "channel_freshness", "channel_hot", "channel_pvuv_windows",
    "new_visitor_flags", "new_visitor_flags_orders", "new_visitor_flags_split",
    "new_visitor_flags_incremental", "click_wide", "user_history", "parse_click_log",
    "round_robin_partition", "kv_get_cell", "kv_get_row", "cdc_flatten",
    "stream_new_visitor_flags", "stream_pvuv", "stream_bulk_totals",
]


def run(query, spark, folder) -> float:
    begin = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "clickflow-bench", master=f"local[{cpus}]", spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    smallest = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(smallest):
        for name in HEADLINE:
            run(queries[name], spark, smallest)
    seconds = {name: run(queries[name], spark, folder) for name in HEADLINE}
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "events_per_sec": {n: round(events / seconds[n]) for n in (
            "channel_pvuv", "channel_freshness", "new_visitor_flags", "stream_pvuv",
            "stream_bulk_totals")},
        "cpus": int(cpus),
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
