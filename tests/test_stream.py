import glob
import json
import os

import pytest

from clickflow.operators import changes
from clickflow.operators.totals import Ledger, add_totals
from clickflow.schemas import CHANGE_RECORD
from clickflow.sources import files
from clickflow.streaming import job
from clickflow.streaming.visitors import stream_visitor_flags
from replay import COLUMNS, flags_of, random_clicks, replay

# Visitor and second of each step, one file and so one micro-batch per step.
STEPS = [("u1", 0), ("u1", 100), ("u1", 101), ("u2", 1), ("u2", 103), ("u9", 200), ("u9", 300)]


def write_step(spark, folder, number, rows):
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(folder)


def write_seconds(spark, folder, steps, start=0):
    for i, (user, second) in enumerate(steps, start):
        write_step(spark, folder, i, [(i, user, "c", 1, second * 1000)])


def clicks_from(spark, folder):
    schema = spark.createDataFrame([], COLUMNS).schema
    return files.stream_files(spark, folder, schema, files_per_batch=1)


def run(spark, tmp, tasks=("channel_pvuv",), start=job.start_click_job):
    query = start(clicks_from(spark, f"{tmp}/in"), f"{tmp}/out", f"{tmp}/checkpoint", tasks,
                  None)
    query.awaitTermination()
    return Ledger(spark, f"{tmp}/out"), query


def windows_of(ledger):
    rows = ledger.windows("channel_pvuv", grains=("hour",)).collect()
    return {r.windowStart // 1000: (r.uv, r.pv) for r in rows}


def test_late_click_misses_its_window_but_is_remembered(spark, tmp_path):
    write_seconds(spark, f"{tmp_path}/in", STEPS)
    ledger, query = run(spark, tmp_path)
    assert windows_of(ledger) == {0: (1, 1), 99: (0, 2), 102: (0, 1), 198: (1, 1)}
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress
                  for op in p["stateOperators"])
    assert dropped == 1


def test_click_just_after_the_mark_moved_is_still_in_time(spark, tmp_path):
    write_seconds(spark, f"{tmp_path}/in", [s for s in STEPS if s != ("u1", 101)])
    ledger, _ = run(spark, tmp_path)
    assert windows_of(ledger)[0] == (2, 2)


def undo_last_commit(checkpoint):
    """Makes the last micro-batch look unfinished, as if the driver had died in it."""
    done = [int(os.path.basename(p)) for p in glob.glob(f"{checkpoint}/commits/[0-9]*")]
    for name in (str(max(done)), f".{max(done)}.crc"):
        path = f"{checkpoint}/commits/{name}"
        if os.path.exists(path):
            os.remove(path)


@pytest.mark.parametrize("start", [job.start_click_job, job.start_bulk_click_job])
def test_restart_replay_and_fold_do_not_count_twice(spark, tmp_path, start):
    write_seconds(spark, f"{tmp_path}/in", STEPS[:3])
    run(spark, tmp_path, start=start)
    undo_last_commit(f"{tmp_path}/checkpoint")
    run(spark, tmp_path, start=start)
    write_seconds(spark, f"{tmp_path}/in", STEPS[3:], start=3)
    ledger, _ = run(spark, tmp_path, start=start)
    totals = {r.yearMonthDayHour: (r.uv, r.pv) for r in ledger.totals("channel_pvuv").collect()}
    # The large-batch job also counts the newest click; its mark is one batch ahead.
    expected = (2, 5) if start is job.start_click_job else (2, 6)
    assert totals == {p: expected for p in ("1970010100", "19700101", "197001")}
    ledger.fold(2)
    ledger.fold(4)
    ledger.fold(4)
    again = {r.yearMonthDayHour: (r.uv, r.pv) for r in ledger.totals("channel_pvuv").collect()}
    assert again == totals
    last = {r.channelId: r.visited for r in ledger.last_windows().collect()}
    assert last == {"c": 1}


def test_stream_flags_equal_replay_over_batches(spark, tmp_path):
    rows = random_clicks(21, 240)
    for number in range(3):
        write_step(spark, f"{tmp_path}/in", number, rows[number * 80:(number + 1) * 80])
    flagged = stream_visitor_flags(clicks_from(spark, f"{tmp_path}/in"))
    job.start_file_sink(flagged, f"{tmp_path}/out", f"{tmp_path}/checkpoint", None,
                        state_partitions=3).awaitTermination()
    assert flags_of(spark.read.parquet(f"{tmp_path}/out")) == replay(rows)[0]


@pytest.mark.parametrize("tasks", [("channel",), ("channel_freshness", "channel")])
def test_chosen_tables(spark, tmp_path, tasks):
    write_seconds(spark, f"{tmp_path}/in", [("a", 0), ("a", 1), ("b", 2), ("a", 60)])
    ledger, query = run(spark, tmp_path, tasks)
    assert [tuple(r) for r in ledger.totals("channel").collect()] == [("c", 3)]
    if "channel_freshness" in tasks:
        fresh = ledger.totals("channel_freshness", grains=("month",)).collect()
        assert [tuple(r) for r in fresh] == [("c", "197001", 2, 0)]
    else:  # heat needs no visitor state
        assert all(len(p["stateOperators"]) <= 1 for p in query.recentProgress)


@pytest.mark.parametrize("start", [job.start_click_job, job.start_bulk_click_job])
def test_folding_on_the_way_changes_no_totals(spark, tmp_path, start):
    write_seconds(spark, f"{tmp_path}/in", STEPS)
    query = start(clicks_from(spark, f"{tmp_path}/in"), f"{tmp_path}/out",
                  f"{tmp_path}/checkpoint", trigger=None, fold_every=2)
    query.awaitTermination()
    ledger = Ledger(spark, f"{tmp_path}/out")
    totals = {(r.uv, r.pv) for r in ledger.totals("channel_pvuv").collect()}
    assert totals == {(2, 5) if start is job.start_click_job else (2, 6)}
    kept = [n for n in os.listdir(f"{tmp_path}/out/sums/deltas") if n.startswith("batch_id")]
    assert "batch_id=1" not in kept
    assert ledger.log.folded_up_to() == 5
    bases = [n for n in os.listdir(f"{tmp_path}/out/sums") if n.startswith("base-")]
    assert sorted(bases) == ["base-3", "base-5"]


def test_unknown_tables_are_refused(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    for tasks in ((), ("visits",)):
        with pytest.raises(ValueError):
            run(spark, tmp_path, tasks)


def test_raw_stream_quarantine(spark, tmp_path):
    good = json.dumps({"count": 2, "timeStamp": 5, "message": '{"userID":1,"channelID":"c"}'})
    files.given_clicks(spark, [good, "nonsense"]).write.parquet(f"{tmp_path}/in")
    raw = files.stream_click_files(spark, f"{tmp_path}/in")
    for name, stream in (("good", job.parse_raw(raw)), ("bad", job.bad_raw(raw))):
        job.start_file_sink(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-checkpoint",
                            None).awaitTermination()
    row = spark.read.parquet(f"{tmp_path}/good").first()
    assert (row.userID, row["count"], row.timestamp) == ("1", 2, 5)
    assert spark.read.parquet(f"{tmp_path}/bad").first().raw == "nonsense"


def test_add_totals_starts_from_nothing(spark):
    nothing = spark.createDataFrame([], "channelId string, visited bigint")
    one = spark.createDataFrame([("a", 2)], "channelId string, visited bigint")
    two = spark.createDataFrame([("a", 3), ("b", 1)], "channelId string, visited bigint")
    total = add_totals("channel", add_totals("channel", nothing, one), two)
    assert sorted(tuple(r) for r in total.collect()) == [("a", 5), ("b", 1)]


def entry(kind, event, rows, offset, table="t"):
    column = lambda value: [{"name": "id", "value": value, "updated": value == "new"}]
    images = [{"beforeColumns": column("old"), "afterColumns": column("new")}] * rows
    header = {"logfileName": "log", "logfileOffset": offset, "schemaName": "db",
              "tableName": table, "executeTime": 9}
    return json.dumps({"entryType": kind, "header": header, "eventType": event,
                       "rowDatas": images})


def test_change_stream(spark, tmp_path):
    batches = [
        [entry("TRANSACTIONBEGIN", None, 0, 1), entry("ROWDATA", "INSERT", 1, 2)],
        [],
        [entry("ROWDATA", "DELETE", 2, 3), "nonsense", entry("ROWDATA", "UPDATE", 0, 4)],
        [entry("TRANSACTIONEND", None, 0, 5)],
        [entry("ROWDATA", "UPDATE", 1, 6), entry("ROWDATA", "UPDATE", 1, 7, table="other")],
    ]
    for texts in batches:
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1) \
            .write.mode("append").text(f"{tmp_path}/in")
    for _ in range(2):
        stream = files.stream_entry_texts(spark, f"{tmp_path}/in", files_per_batch=1)
        job.start_change_job(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint",
                             pattern=r"db\.t", trigger=None,
                             send=lambda r: r.write.mode("append").json(f"{tmp_path}/topic"),
                             ).awaitTermination()
        undo_last_commit(f"{tmp_path}/checkpoint")
    records = spark.read.parquet(f"{tmp_path}/out/records")
    found = sorted((r.logFileOffset, r.eventType, r.emptyCount, r.rowIndex,
                    r.columnValueList[0].columnValue, r.columnValueList[0].isValid)
                   for r in records.collect())
    assert found == [
        (2, "INSERT", 1, 0, "new", True),
        (3, "DELETE", 2, 0, "old", False), (3, "DELETE", 2, 1, "old", False),
        (6, "UPDATE", 4, 0, "new", True),
    ]
    assert [r.raw for r in spark.read.parquet(f"{tmp_path}/out/bad").collect()] == ["nonsense"]
    topic = spark.read.json(f"{tmp_path}/topic")
    assert topic.count() == len(found) + 1  # the last batch was sent twice
    assert topic.distinct().count() == len(found)
    sent = changes.topic_records(records).collect()
    assert len({r.key for r in sent}) == len(found)
    assert set(json.loads(sent[0].value)) == set(CHANGE_RECORD.names)
    assert len({r.key for r in changes.topic_records(records, "random").collect()}) == len(found)
    with pytest.raises(ValueError):
        changes.topic_records(records, "none")


def test_change_entries_are_kept_in_a_table_not_in_memory(spark, tmp_path):
    def cached():
        return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())

    before, more, sent = cached(), set(), []

    def send(records):
        more.update(cached() - before)
        sent.append(records.count())

    texts = [entry("ROWDATA", "INSERT", 1, n) for n in range(1, 8)] + ["nonsense"]
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(f"{tmp_path}/in")
    job.start_change_job(files.stream_entry_texts(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint",
                         trigger=None, send=send, fetch_entries=3, order=("value",)).awaitTermination()
    assert sent == [7] and not more
    records = spark.read.parquet(f"{tmp_path}/out/records").collect()
    assert {r.logFileOffset: r.emptyCount for r in records} == {1: 1, 2: 1, 3: 2, 4: 2, 5: 2, 6: 3, 7: 3}
    assert [r.raw for r in spark.read.parquet(f"{tmp_path}/out/bad").collect()] == ["nonsense"]
    kept = spark.read.parquet(f"{tmp_path}/out/parsed")
    assert kept.count() == 8 and [r.raw for r in kept.where("raw IS NOT NULL").collect()] == ["nonsense"]
