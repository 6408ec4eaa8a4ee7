from datetime import datetime, timezone
from types import SimpleNamespace

import pytest

from clickflow.operators import numbering
from clickflow.session import work_folder
from clickflow.sources import kafka
from clickflow.streaming.windows import event_ms


def test_kafka_options():
    options = kafka.kafka_options("h:9092", retries=0, batch_size=16384, linger_ms=1,
                                  buffer_memory=33554432, group_id="g")
    assert options == {
        "kafka.bootstrap.servers": "h:9092", "kafka.retries": "0", "kafka.batch.size": "16384",
        "kafka.linger.ms": "1", "kafka.buffer.memory": "33554432", "kafka.group.id": "g"}


def test_topic_records_are_numbered_by_time_then_offset(spark):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(bytearray(b"c"), at, 1, 7), (bytearray(b"a"), at, 0, 2**20 - 1),
            (bytearray(b"b"), at, 0, 2**20), (bytearray(b"d"), at, 1, 2**62)]
    records = kafka.number_topic_records(spark.createDataFrame(
        rows, "value binary, timestamp timestamp, partition int, offset bigint"))
    found = records.orderBy("seq").collect()
    assert [r.value for r in found] == ["a", "b", "c", "d"] and len({r.seq for r in found}) == 4
    assert found[0].arrivalMs == 1704067200000 and found[0].seq < found[1].seq
    same = kafka.number_topic_records(spark.createDataFrame(
        [(bytearray(b"x"), at, p, 7) for p in (0, 1)],
        "value binary, timestamp timestamp, partition int, offset bigint"))
    assert same.select("seq").distinct().count() == 2


def test_event_time_is_the_later_of_the_two(spark):
    rows = spark.createDataFrame([(5, 9), (9, 5), (5, None)], "timestamp bigint, arrivalMs bigint")
    assert [r[0] for r in rows.select(event_ms(rows)).collect()] == [9, 9, 5]


def test_records_are_dealt_out_evenly(spark):
    sizes = kafka.even_out(spark.range(0, 90, 1, 2), 3).rdd.glom().map(len).collect()
    assert sizes == [30, 30, 30]
    assert kafka.even_out(spark.range(5), None).count() == 5


@pytest.mark.parametrize("width,span", [(1, 2), (7, 3), (7, 1 << 20), (1 << 20, 1 << 20)])
def test_numbering_equals_plain_counting(spark, width, span):
    values = [v * v - 500 for v in range(0, 60)] + [-(1 << 62), 1 << 62]
    df = spark.createDataFrame([(v,) for v in reversed(sorted(set(values)))], "v bigint")
    found = numbering.number_in_order(df, "v", "n", width, span).orderBy("v").collect()
    assert [r.n for r in found] == list(range(1, len(set(values)) + 1))


def test_round_robin_restarts_after_65536_sends(spark):
    df = spark.range(65540).withColumnRenamed("id", "seq")
    found = numbering.round_robin_partition(df, "seq", 3).orderBy("seq").collect()
    counter, want = 0, []
    for _ in range(65540):
        counter += 1
        want.append(counter % 3)
        if counter > 65535:
            counter = 0
    assert [r.partition for r in found] == want


def session_like(master, shared):
    conf = SimpleNamespace(get=lambda name, default: shared)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_folder_is_below_the_shared_one():
    cluster = session_like("yarn", "hdfs://shared/")
    one, two = work_folder(cluster, "x"), work_folder(cluster, "x")
    assert one.startswith("hdfs://shared/x-") and one != two
    with pytest.raises(ValueError):
        work_folder(session_like("yarn", None), "x")


def test_numbers_follow_any_columns(spark):
    rows = [(f"f{k % 3}", (k * 37) % 101, str(k)) for k in range(101)]
    numbered = numbering.number_by(spark.createDataFrame(rows, "file string, at bigint, t string").repartition(7), ["file", "at"], "n")
    assert [(r.file, r.at) for r in sorted(numbered.collect(), key=lambda r: r.n)] == sorted((f, a) for f, a, _ in rows)
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 102))
