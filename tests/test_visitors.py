import pytest
from pyspark.sql import functions as F

from clickflow.operators import history, metrics, visitors
from clickflow.operators.skew import HotKeys, find_hot_keys
from replay import COLUMNS, flags_of, random_clicks, replay


def forced_hot(clicks, **more):
    limits = {"fraction": 1.0, "hot_share": 0.2, "least_rows": 1, "limits": 16}
    return visitors.hot_visitors(clicks, **{**limits, **more})


@pytest.mark.parametrize("seed", [1, 2])
def test_flags_equal_replay(spark, seed):
    rows = random_clicks(seed)
    clicks = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert flags_of(visitors.visitor_flags(clicks)) == replay(rows)[0]


@pytest.mark.parametrize("seed,blocks", [(3, 2), (4, 7), (5, 5000)])
def test_split_visitors_equal_replay(spark, seed, blocks):
    rows = random_clicks(seed)
    clicks = spark.createDataFrame(rows, COLUMNS).repartition(5)
    hot = forced_hot(clicks, limits=blocks)
    assert hot.keys == (("hot", "x"),)
    assert flags_of(visitors.visitor_flags(clicks, hot)) == replay(rows)[0]


def test_split_visitors_with_outlying_numbers(spark):
    rows = random_clicks(6)
    rows[0] = (-(10**15), *rows[0][1:])
    rows[-1] = (10**15, *rows[-1][1:])
    clicks = spark.createDataFrame(rows, COLUMNS)
    assert flags_of(visitors.visitor_flags(clicks, forced_hot(clicks))) == replay(rows)[0]


@pytest.mark.parametrize("split", [False, True])
def test_batches_with_history_equal_replay(spark, tmp_path, split):
    rows = random_clicks(7, 300)
    table = history.VisitorHistory(spark, str(tmp_path))
    found = {}
    for number in range(3):
        clicks = spark.createDataFrame(rows[number * 100:(number + 1) * 100], COLUMNS)
        hot = forced_hot(clicks) if split else None
        for _ in range(2):  # the second turn is a replay of the same batch
            found.update(flags_of(table.flag(clicks, number, hot)))
            table.append(clicks, number)
        if number == 1:
            table.fold(0)
    flags, last = replay(rows)
    assert found == flags
    table.fold(1)
    table.fold(1)
    kept = {(r.userid, r.channelid): r.lastVisitedTime for r in table.snapshot().collect()}
    assert kept == last


def test_update_history_equals_replay(spark):
    rows = random_clicks(8)
    first, second = (spark.createDataFrame(part, COLUMNS) for part in (rows[:150], rows[150:]))
    nothing = spark.createDataFrame([], "userid string, channelid string, lastVisitedTime bigint")
    kept = visitors.update_history(visitors.update_history(nothing, first), second)
    assert {(r.userid, r.channelid): r.lastVisitedTime for r in kept.collect()} == replay(rows)[1]


def test_hot_keys_are_looked_for_within_bounds(spark):
    clicks = spark.createDataFrame(random_clicks(9), COLUMNS)
    assert forced_hot(clicks, hot_share=0.9) is None
    assert find_hot_keys(clicks.limit(0), ["userID"], "seq") is None
    with pytest.raises(ValueError):
        forced_hot(clicks, hot_share=1e-9)


def test_blocks_rise_with_the_number(spark):
    hot = HotKeys(("k",), (("a",),), (tuple(range(0, 1000, 10)),))
    numbers = [("a", n) for n in (-10**12, -1, 0, 5, 10, 329, 330, 990, 10**12)] + [("b", 7)]
    found = {(r.k, r.n): r.block for r in hot.mark(
        spark.createDataFrame(numbers, "k string, n bigint"), "n", "hot", "block").collect()}
    assert [found["a", n] for n in (-10**12, -1, 0, 5, 10, 329, 330, 990, 10**12)] == [
        1, 1, 2, 2, 3, 34, 35, 101, 101]
    assert found["b", 7] is None


def test_blocks_are_even_with_outliers_and_a_burst(spark):
    rows = spark.range(100_000).select(
        F.lit("a").alias("userID"), F.lit("x").alias("channelID"),
        F.when(F.col("id") < 50_000, F.col("id") * 1_000_000).when(F.col("id") < 99_000, 10**12 + F.col("id"))
        .otherwise(F.col("id") * 10**12).alias("seq"))
    hot = visitors.hot_visitors(rows, fraction=1.0, limits=64)
    sizes = sorted(r["count"] for r in hot.mark(rows, "seq", "hot", "block").groupBy("block").count().collect())
    assert len(sizes) == 64 and sizes[-1] < 2 * sizes[len(sizes) // 2]
