"""The plans that matter at scale keep their shape."""

import re

from pyspark.sql import functions as F

from clickflow.operators import totals
from clickflow.plans.catalog import all_queries
from clickflow.session import setting

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    df = all_queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_shuffles_clicks_once(spark):
    text = plan(spark, "channel_pvuv")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3
    assert "Python" not in text and "Pandas" not in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint," \
           "event_type:string>" in text
    # Clicks are summed on the map side before anything is spread over periods.
    assert text.index("Generate stack") < text.index("partial_sum(1)")


def test_heat_reads_one_column_and_needs_no_visitors(spark):
    text = plan(spark, "channel_hot")
    assert "ReadSchema: struct<event_type:string>" in text
    assert "Window" not in text


def test_split_visitors_join_on_the_exchange_they_have(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(spark, "new_visitor_flags_split")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = text[text.index("SortMergeJoin"):]
    above_window = left[:left.index("Window")]
    assert "Exchange" not in above_window and "Sort [" not in above_window


def test_no_query_runs_in_one_task_or_as_a_cross_join(spark):
    for name in all_queries():
        if name.startswith("stream_"):
            continue
        text = plan(spark, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        for single in re.findall(r"Exchange SinglePartition.*\n.*", text):
            assert "HashAggregate(keys=[_span" in single, name


def test_change_entries_are_read_and_parsed_once(spark):
    for name, parses in (("cdc_decode", 1), ("cdc_flatten", 0)):
        text = plan(spark, name)
        assert text.count("FileScan parquet") <= 2, name
        assert len(re.findall(r"from_json\(", text)) == parses, name


def test_running_totals_spread_a_channel_that_holds_half_the_rows(spark):
    windows = spark.range(200_000).select(
        (F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.floor(F.col("id") / 40) * 2) * 3000).alias("windowStart"),
        F.when(F.col("id") % 2 == 0, "big").otherwise(F.concat(F.lit("c"), F.floor(F.col("id") / 2) % 20))
        .alias("channelId"), F.lit("2024").alias("yearMonthDayHour"), F.lit(1).alias("pv"), F.lit(2).alias("uv"))
    windows = windows.dropDuplicates(["windowStart", "channelId"])
    with setting(spark, spark__sql__adaptive__enabled="false"):
        found = totals.totals_by_window("channel_pvuv", windows, block_windows=512)
        tasks = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
    assert tasks[-1] < 3 * tasks[len(tasks) // 2] and len(tasks) == 8
    last = {r.channelId: (r.pv, r.uv) for r in found.groupBy("channelId").agg(
        F.max("pv").alias("pv"), F.max("uv").alias("uv")).collect()}
    counts = {r.channelId: r["count"] for r in windows.groupBy("channelId").count().collect()}
    assert last == {c: (n, 2 * n) for c, n in counts.items()} and counts["big"] == 100_000
