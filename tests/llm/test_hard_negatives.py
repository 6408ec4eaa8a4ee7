"""Hard negatives against plain inner products over all rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickflow.llm import hard_negatives as mining
from clickflow.llm import queries
from oracle import assert_same

SMALL = "/root/testdata/sf0.01"
TYPES = "id bigint, label int, vector array<float>"


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    ready = {(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)) for i, label, vector in rows
             if i is not None and label is not None and vector is not None
             and all(x is not None and math.isfinite(x) for x in vector)}

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))
    out = []
    for anchor in ready:
        if not is_anchor(anchor[0]):
            continue
        ranked = sorted(((-score(anchor[2], r[2]), *r) for r in ready if r != anchor))
        for p in [r for r in ranked if r[2] == anchor[1]][:positives]:
            fit = [r for r in ranked if r[2] != anchor[1] and low * -p[0] <= 100 * -r[0] <= high * -p[0]][:negatives]
            out += [(anchor[0], p[1], k, r[1], -p[0], -r[0]) for k, r in enumerate(fit, 1)]
    return sorted(out)


def random_rows(seed, count=400):
    rng = random.Random(seed)
    rows = []
    for k in range(count):
        vector = [rng.choice([-2, -1, 0, 0.5, 1, 1.5, 2]) / 4 for _ in range(rng.choice([12, 12, 12, 7, 0]))]
        rows.append((rng.choice([k, k, k // 10]), rng.choice([1, 1, 1, 2, 3]), vector))
    rows += rows[:40] + [(0, 1, None), (10, None, [1.0]), (None, 1, [1.0]), (20, 1, [None, 1.0]), (30, 1, [float("nan")]),
                         (40, 2, [float("inf")]), (50, 2, [0.0] * 20), (60, 2, [3.0] * 20)]
    return rows


@pytest.mark.parametrize("block", [40, mining.LEAST_ROWS])
def test_negatives_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(mining, "LEAST_ROWS", block)
    rows = random_rows(block)
    found = mining.hard_negatives(spark.createDataFrame(rows, TYPES), F.col("id") % 10 == 0)
    want = brute(rows, lambda i: i % 10 == 0)
    assert sorted(tuple(r) for r in found.collect()) == want and len(want) > 1_000


def test_scores_are_exact_at_any_size():
    rng = np.random.default_rng(1)
    for largest, kind in [(1, "i4"), (300, "i4"), (2 ** 28, "i8")]:
        anchors, others = (rng.integers(-largest, largest + 1, (n, 16)) for n in (70, 5_000))
        planes = int(max(abs(anchors).max(), abs(others).max())).bit_length() + 1
        got = mining.inner_products(mining.subset_sums(anchors, kind), mining.bit_planes(others, planes))
        assert (got == anchors @ others.T).all()


def test_sql_on_the_larger_table(spark):
    assert assert_same(queries.QUERIES["op11_hard_negatives"](spark, SMALL), queries.ORACLES["op11_hard_negatives"], SMALL) > 100


def test_edges(spark):
    every = F.lit(True)
    assert mining.hard_negatives(spark.createDataFrame([], TYPES), every).count() == 0
    same = spark.createDataFrame([(k, k % 2, [1.0, 1.0]) for k in range(30)], TYPES).withColumn("row", F.lit("x"))
    assert mining.hard_negatives(same, every).count() == 0  # no score in range
    wide = mining.hard_negatives(same, every, high=100).where("anchor_id = 0").collect()
    assert [(r.positive_id, r.negative_id) for r in sorted(wide, key=lambda r: (r.positive_id, r.rank))] == [
        (p, n) for p in (2, 4, 6, 8, 10) for n in range(1, 21, 2)]
    with pytest.raises(ValueError):
        mining.hard_negatives(spark.createDataFrame([(1, 1, [1e30])], TYPES), every)
