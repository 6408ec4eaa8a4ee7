from pyspark.sql import functions as F

from clickflow.sources import files
from clickflow.streaming import job
from clickflow.streaming.visitors import state_history, stream_visitor_flags
from replay import COLUMNS, blank, flags_of, random_clicks, replay


def run_batches(spark, folder, batches, slots):
    """Flags of clicks fed one file and so one micro-batch at a time."""
    schema = spark.createDataFrame([], COLUMNS).schema
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = files.stream_files(spark, f"{folder}/in", schema, files_per_batch=1)
        flagged = stream_visitor_flags(stream, slots=slots)
        job.start_file_sink(flagged, f"{folder}/out", f"{folder}/checkpoint", None,
                            state_partitions=2).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def test_visitors_of_a_slot_share_its_state_but_not_their_clicks(spark, tmp_path):
    rows = random_clicks(5, 300) + [(9000 + n, f"v{n % 40}", "x", 1, 1704067200000 + n) for n in range(60)]
    found = run_batches(spark, tmp_path, (rows[:100], rows[100:200], rows[200:]), slots=3)
    flags, history = replay(rows)
    assert flags_of(found) == flags
    kept = state_history(spark, f"{tmp_path}/checkpoint")
    assert {(r.userid, r.channelid): r.lastVisitedTime for r in kept.collect()} == {
        k: ms for k, ms in history.items() if not blank(k[0])}
    state = spark.read.format("statestore").load(f"{tmp_path}/checkpoint")
    assert state.count() <= 3


def test_state_rows_stop_growing_with_visitors(spark, tmp_path):
    slots = 7
    rows = [(n, f"v{n}", "x", 1, n) for n in range(500)]
    found = run_batches(spark, tmp_path, (rows[:300], rows[300:]), slots=slots)
    assert found.where("isNew = 1").count() == 500
    assert spark.read.format("statestore").load(f"{tmp_path}/checkpoint").count() == slots
    assert state_history(spark, f"{tmp_path}/checkpoint").agg(F.count_distinct("userid")).first()[0] == 500


def test_click_without_a_time_is_a_click_all_the_same(spark, tmp_path):
    day = 86400_000
    rows = [(0, "a", "x", 1, day), (1, "b", "x", 1, day), (2, "a", "x", 1, None), (3, "b", "x", 1, 2 * day)]
    found = run_batches(spark, tmp_path, (rows[:2], rows[2:]), slots=1)
    assert {r.seq: r.isNew for r in found.collect()} == {0: 1, 1: 1, 2: 0, 3: 0}
    kept = state_history(spark, f"{tmp_path}/checkpoint")
    assert {r.userid: r.lastVisitedTime for r in kept.collect()} == {"a": None, "b": 2 * day}
