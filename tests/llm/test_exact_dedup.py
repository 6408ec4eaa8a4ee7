"""Exact duplicates against grouping by content, with tables that spill and hashes that collide."""

from __future__ import annotations

import collections
import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickflow.llm import exact_dedup

ROWS = [(None if k % 50 == 0 else k % 40, f"text {k % 7}" * (k % 5)) for k in range(900)] \
    + [(3, None), (4, ""), (None, None), (7, "x" * 300_000), (8, "x" * 300_000 + "y"), (9, "x" * 300_000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id int, text string").repartition(9)


zeros = lambda text: b"\0" * 8  # noqa: E731  a lambda goes to the workers as it is
few = lambda text: bytes([len(text) % 3]) * 8


@pytest.mark.parametrize("limits", [
    {}, {"budget": 2_000, "many": 3}, {"budget": 1, "many": 2, "hashed": zeros}, {"budget": 2_000, "hashed": few}])
def test_groups_equal_brute_force(docs, limits):
    ids = collections.defaultdict(list)
    for doc_id, text in ROWS:
        ids[hashlib.sha256((text or "").encode()).hexdigest()].append(doc_id)
    found = exact_dedup.exact_duplicates(docs, **limits).collect()
    assert collections.Counter((r.doc_id, r.text_sha256) for r in found) == collections.Counter(
        (i, sha) for sha, group in ids.items() for i in group)
    stays = collections.Counter()
    for r in found:
        group = ids[r.text_sha256]
        assert r.group_size == len(group)
        assert r.keep_id == max((i for i in group if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
        stays[r.text_sha256] += r.kept
    assert set(stays.values()) == {1}


def test_tables_stay_within_their_budget():
    schema = pa.schema([("row", pa.int64()), ("text", pa.binary()), ("size", pa.int64()),
                        ("keep_id", pa.int64()), ("keep_row", pa.int64())])
    texts = [b"%06d" % (k % 3_000) * 20 for k in range(6_000)]
    batches = [pa.record_batch([list(range(k, k + 500)), texts[k:k + 500], [1] * 500, list(range(k, k + 500)),
                                list(range(k, k + 500))], schema=schema) for k in range(0, 6_000, 500)]
    budget, tables, heads = 100_000, 0, set()
    for kind, *found in exact_dedup.groups(batches, schema, budget=budget):
        if kind == "texts":
            tables += 1
            assert sum(len(t) + exact_dedup.ENTRY_BYTES for t in found[1]) <= budget + 120 + exact_dedup.ENTRY_BYTES
            assert all(s[0] == 2 for s in found[2])
            heads |= set(found[1])
    assert heads == set(texts) and tables > 10


def test_rows_that_stay_keep_all_columns(spark, docs):
    named = docs.withColumn("row", F.col("text")).withColumn("whole", F.col("doc_id")).withColumn("keep_id", F.lit(1))
    stays = exact_dedup.without_copies(named)
    assert stays.columns == named.columns
    assert stays.count() == len({t or "" for _, t in ROWS})
    assert exact_dedup.exact_duplicates(docs.where("false")).count() == 0


def test_ids_may_be_texts(spark):
    rows = spark.createDataFrame([("a", "t"), ("b", "t"), (None, "t")], "doc_id string, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.exact_duplicates(rows).collect()} == {
        ("a", "b", False), ("b", "b", True), (None, "b", False)}
