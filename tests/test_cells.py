import random

from clickflow.operators import cells
from clickflow.schemas import CELL_LOG


def rows_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_puts_gets_and_deletes(spark, tmp_path):
    table = cells.open_table(spark, f"{tmp_path}/t")
    assert table.log().count() == 0
    puts = spark.createDataFrame(
        [("r1", {"a": "1", "b": "2"}, 1), ("r2", {"a": "x", "b": ""}, 2),
         ("r3", {"a": "1", "b": None}, 3), (None, {"a": "1"}, 4), ("r4", {}, 5),
         ("r5", None, 6)],
        "rowkey string, values map<string,string>, seq bigint")
    table.write(cells.put_rows(puts))
    assert rows_of(cells.rejected_puts(puts), "seq") == [(3,), (4,), (5,), (6,)]
    single = spark.createDataFrame([("r1", "9", 7), ("r2", None, 8)],
                                   "rowkey string, value string, seq bigint")
    table.write(cells.put_cells(single, "a"))
    again = cells.open_table(spark, f"{tmp_path}/t")
    assert rows_of(cells.current_cells(again.log()), "rowkey", "column", "value") == [
        ("r1", "a", "9"), ("r1", "b", "2"), ("r2", "a", "x"), ("r2", "b", "")]

    asked = spark.createDataFrame(
        [("r1", "a"), ("r1", "z"), ("r2", "b"), ("r9", "a"), ("r1", "a")],
        "rowkey string, column string")
    assert rows_of(cells.get_cell(asked, again.log()), "rowkey", "column", "value") == [
        ("r1", "a", "9"), ("r1", "a", "9"), ("r1", "z", ""), ("r2", "b", ""), ("r9", "a", "")]
    keys = spark.createDataFrame([("r1",), ("r2",), ("r9",)], "rowkey string")
    found = {r.rowkey: r["values"] for r in cells.get_row(
        keys, again.log(), ["a", "b", "z"]).collect()}
    assert found == {"r1": {"a": "9", "b": "2"}, "r2": {"a": "x"}, "r9": {}}

    table.write(cells.delete_rows(spark.createDataFrame([("r1", 10)], "rowkey string, seq bigint")))
    table.write(cells.put_cells(spark.createDataFrame(
        [("r1", "back", 11)], "rowkey string, value string, seq bigint"), "b"))
    assert rows_of(cells.get_cell(asked, table.log()).distinct(), "rowkey", "column", "value")[0] \
        == ("r1", "a", "")
    found = {r.rowkey: r["values"] for r in cells.get_row(keys, table.log(), ["a", "b"]).collect()}
    assert found["r1"] == {"b": "back"}


def test_random_log_equals_replay(spark):
    rng = random.Random(5)
    log, state = [], {}
    for seq in range(600):
        key = "hot" if rng.random() < 0.4 else rng.choice("pqrs")
        if rng.random() < 0.1:
            log.append((key, "info", None, None, seq, "delete"))
            state.pop(key, None)
        else:
            column, value = rng.choice("abc"), rng.choice(["", "1", "2", "3"])
            log.append((key, "info", column, value, seq, "put"))
            state.setdefault(key, {})[column] = value
    rng.shuffle(log)
    df = spark.createDataFrame(log, CELL_LOG).repartition(4)
    want = sorted((k, c, v) for k, cs in state.items() for c, v in cs.items())
    assert rows_of(cells.current_cells(df), "rowkey", "column", "value") == want
    keys = spark.createDataFrame([(k,) for k in ["hot", *"pqrs"]], "rowkey string")
    found = {r.rowkey: r["values"] for r in cells.get_row(keys, df, list("abc")).collect()}
    assert found == {k: {c: v for c, v in state.get(k, {}).items() if v}
                     for k in ["hot", *"pqrs"]}


def test_families_are_apart(spark):
    put = spark.createDataFrame([("r", "1", 1)], "rowkey string, value string, seq bigint")
    log = cells.put_cells(put, "a", family="f").unionByName(
        cells.delete_rows(put.selectExpr("rowkey", "seq + 1 AS seq"), family="g"))
    asked = spark.createDataFrame([("r", "a")], "rowkey string, column string")
    assert cells.get_cell(asked, log, family="f").first().value == "1"
    assert cells.get_cell(asked, log, family="g").first().value == ""


def test_folds_say_the_same(spark, tmp_path):
    rng = random.Random(11)
    table = cells.open_table(spark, f"{tmp_path}/t", buckets=4)
    written = []
    for batch in range(5):
        rows = [(f"r{rng.randint(0, 15)}", "info", c, None if c is None else str(rng.randint(0, 9)),
                 batch * 100 + k - 150 * (k % 7 == 0), "delete" if c is None else "put")
                for k in range(60) for c in [rng.choice(["a", "b", "c", None])]]
        written += rows
        table.write(spark.createDataFrame(rows, CELL_LOG))
        if batch in (1, 3):
            table.fold(batch)  # late puts and deletions with lower numbers still follow
        want = rows_of(cells.current_cells(spark.createDataFrame(written, CELL_LOG)), "rowkey", "column", "value", "seq")
        assert rows_of(cells.current_cells(table.log()), "rowkey", "column", "value", "seq") == want
    table.fold()
    table.fold()
    assert rows_of(cells.current_cells(table.log()), "rowkey", "column", "value", "seq") == want
    assert all(len(b) == 1 for b in table.table.batches().values())
    assert table.log().count() == len(want) + len({r[0] for r in written if r[5] == "delete"})


def test_point_reads_skip_files(spark, tmp_path):
    table = cells.open_table(spark, f"{tmp_path}/t", buckets=16)
    table.write(cells.put_rows(spark.createDataFrame(
        [(f"r{k}", {"a": str(k)}, k) for k in range(500)], "rowkey string, values map<string,string>, seq bigint")))
    log = table.point_log("r17")
    assert rows_of(log, "rowkey", "value") == [("r17", "17")]
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert len(log.inputFiles()) == 16 and "PartitionFilters: [isnotnull(shard" in plan
    assert "EqualTo(rowkey,r17)" in plan and "EqualTo(slot," in plan
    rows = cells.get_row(spark.createDataFrame([("r17",), ("none",)], "rowkey string"), log, ["a", "b"])
    assert {r.rowkey: r["values"] for r in rows.collect()} == {"r17": {"a": "17"}, "none": {}}
