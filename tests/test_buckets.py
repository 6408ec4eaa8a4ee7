"""Bucketed tables: what a lookup reads, how it joins, and folding bucket by bucket."""

import re

import pytest
from pyspark.sql import functions as F

from clickflow.operators.buckets import BucketTable
from clickflow.operators.history import JOIN_SETTINGS, VisitorHistory
from clickflow.session import setting
from replay import COLUMNS


def clicks_of(spark, users, seq=0):
    rows = [(seq + k, user, "x", 1, 1704067200000 + k) for k, user in enumerate(users)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    table = VisitorHistory(spark, str(tmp_path_factory.mktemp("h")), buckets=16)
    for number in range(3):
        table.append(clicks_of(spark, [f"u{k}" for k in range(2_000)]), number)
    return table


def bytes_read(spark, df):
    """What the scan of a query without exchanges reads."""
    with setting(spark, spark__sql__adaptive__enabled="false"):
        plan = df.select("*")._jdf.queryExecution().executedPlan()
    plan.executeCollectPublic()
    return plan.collectLeaves().apply(0).metrics().get("filesSize").get().value()


def test_lookup_reads_the_buckets_it_touches(spark, history):
    every = bytes_read(spark, history.table.rows())
    for users in (["u1"], ["u1", "u2", "u3", "new"]):
        clicks = clicks_of(spark, users)
        slots = history.table.touched(clicks, "userID", "channelID")
        buckets = {r[0] for r in clicks.select(F.pmod(
            F.hash(history.table.slot("userID", "channelID")), F.lit(16))).collect()}
        known = history.known(clicks, 3)
        plan = known._jdf.queryExecution().executedPlan().toString()
        formatted = known._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert f"SelectedBucketsCount: {len(buckets)} out of 16" in formatted
        assert "Exchange" not in plan and ("In(slot" in plan or f"EqualTo(slot,{slots[0]})" in plan)
        assert 0 < bytes_read(spark, known) < every * (len(buckets) + 1) / 16
        assert {r.userid for r in known.collect()} >= set(users) - {"new"}
    assert history.known(clicks_of(spark, []), 3).count() == 0


def test_lookup_moves_no_history(spark, history):
    clicks = clicks_of(spark, [f"u{k}" for k in range(0, 4_000, 7)])
    with setting(spark, spark__sql__autoBroadcastJoinThreshold="-1", **JOIN_SETTINGS):
        plan = history.flag(clicks, 3)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scan = next(k for k, line in enumerate(lines) if "FileScan" in line)
    join = max(k for k, line in enumerate(lines[:scan]) if "SortMergeJoin" in line)
    # the clicks' side of the join comes first and has the exchanges; the history's side has none
    indent = re.match(r"\W*", lines[join + 1]).end()
    history_side = next(k for k in range(join + 2, scan) if re.match(r"\W*", lines[k]).end() == indent)
    assert not any("Exchange" in line for line in lines[history_side:scan])
    assert any("Exchange hashpartitioning(_ask" in line and ", 16)" in line for line in lines[join:history_side])
    flags = {r.userID: r.isNew for r in history.flag(clicks, 3).collect()}
    assert all(new == (int(user[1:]) >= 2_000) for user, new in flags.items())


def test_folds_touch_full_buckets_only(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path), "k string, v bigint", ["k"], buckets=4)

    def newest(rows):
        return rows.groupBy("slot", "shard", "k").agg(F.max_by("v", "batch_id").alias("v"))

    keys = [f"k{n}" for n in range(200)]
    table.append(spark.createDataFrame([(k, 0) for k in keys], "k string, v bigint"), 0)
    for number in range(1, 4):
        table.append(spark.createDataFrame([("k7", number)], "k string, v bigint"), number)
    before = {r.k: r.v for r in newest(table.rows()).collect()}
    assert sorted(len(b) for b in table.batches().values()) == [1, 1, 1, 4]
    assert len(table.fold(3, newest)) == 1
    assert {r.k: r.v for r in newest(table.rows()).collect()} == before  # beside what was folded
    again = BucketTable(spark, str(tmp_path), "k string, v bigint", ["k"])
    assert again.buckets == 4 and again.last_batch() == 3
    assert again.fold(3, newest) == []  # deletes what the fold stands for
    assert sorted(len(b) for b in again.batches().values()) == [1, 1, 1, 1]
    assert {r.k: r.v for r in again.rows().collect()} == before == {k: 3 if k == "k7" else 0 for k in keys}
