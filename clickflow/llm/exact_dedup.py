"""Exact duplicates by Grace hashing: partition, spill, compare complete contents.

Every task reads its rows into an open-addressing table that holds each distinct text once. A row
whose whole text, byte for byte, is in the table joins that text's group; the hash only says
where to look. When the texts of a table reach ``BUDGET`` bytes, it takes no new ones: rows that
are not in it are dealt by their hash over ``FANOUT`` spill files in Spark's own spill folders,
and each file is worked off in the same way, with other bits of the hash, when the table is done.
So a task holds ``BUDGET`` bytes of text, or a single text that is longer.

This runs twice. First where the rows are read, before any shuffle: a third of all rows with one
text leave one row per task. What is left of each text, with its number of rows and its largest
doc_id, is then shuffled by hash and gone through in the same way. Where a hash still has more
than ``MANY`` rows, they meet in groups of at most ``MANY`` tasks first, as often as needed, so no
task takes a text from all tasks of a large cluster.

Defined results: a null text counts as empty, and all empty texts are equal; texts are compared
as they are, whatever their length. The row with the largest doc_id stays; null doc_ids are
smaller than all others, and of several rows with the same doc_id one stays. An empty table gives
no rows. Only ``doc_id`` (of any type that can be ordered) and ``text`` are read; ``without_copies``
gives back every column, whatever its name.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from clickflow.llm.common import keep_table, table

BUDGET, ENTRY_BYTES = 64 << 20, 300  # bytes a table holds: of texts, and of what goes with each
FANOUT, LEVELS = 32, 12
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2_000
MANY = 64
SPREAD = 0x9E3779B97F4A7C15

# What a row says of the rows it stands for.
STANDS_FOR = ["size", "keep_id", "keep_row"]


def content_hash(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


class ContentTable:
    """An open-addressing table from whole contents to numbers 0, 1, 2, ..."""

    def __init__(self):
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.bytes = 0

    def _slot(self, mark: int, text: bytes) -> int:
        """The slot that holds the content, or the free one where it belongs."""
        last = len(self.slots) - 1
        slot = (mark * SPREAD >> 40) & last  # all marks of a spill file have some bits in common
        while (found := self.slots[slot]) >= 0:
            if self.hashes[found] == mark and self.texts[found] == text:
                break
            slot = (slot + 1) & last
        return slot

    def find(self, mark: int, text: bytes, full: bool) -> int:
        """The content's number; a new one if it is new, or -1 if the table is ``full``."""
        slot = self._slot(mark, text)
        if self.slots[slot] >= 0:
            return int(self.slots[slot])
        if full:
            return -1
        number = len(self.texts)
        self.slots[slot] = number
        self.hashes.append(mark)
        self.texts.append(text)
        self.bytes += len(text) + ENTRY_BYTES
        if 2 * len(self.texts) > len(self.slots):
            self._grow()
        return number

    def _grow(self) -> None:
        self.slots = np.full(4 * len(self.slots), -1, np.int64)
        for number, (mark, text) in enumerate(zip(self.hashes, self.texts)):
            self.slots[self._slot(mark, text)] = number


class Spill:
    """Arrow batches in ``FANOUT`` files of one task, dealt by some bits of the hash."""

    def __init__(self, folder: str, schema: pa.Schema, level: int):
        self.folder, self.schema, self.level = folder, schema, level
        self.writers: dict[int, pa.RecordBatchStreamWriter] = {}

    def add(self, batch: pa.RecordBatch, marks: list[int]) -> None:
        step = FANOUT.bit_length() - 1
        files = np.array([mark >> (step * self.level) & (FANOUT - 1) for mark in marks])
        for file in np.unique(files).tolist():
            if file not in self.writers:
                self.writers[file] = pa.ipc.new_stream(f"{self.folder}/{file}", self.schema)
            self.writers[file].write_batch(batch.take(pa.array(np.flatnonzero(files == file))))

    def close(self) -> list[str]:
        for writer in self.writers.values():
            writer.close()
        return [f"{self.folder}/{file}" for file in self.writers]


def spill_folder() -> str:
    """One of the folders Spark gives its tasks for spilled data."""
    return os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")[0]


def _read(path: str) -> Iterator[pa.RecordBatch]:
    with pa.OSFile(path) as file, pa.ipc.open_stream(file) as stream:
        yield from stream


def groups(batches: Iterable[pa.RecordBatch], schema: pa.Schema, level: int = 0, budget: int = BUDGET,
           hashed=content_hash) -> Iterator[tuple]:
    """Groups of equal contents: ``("rows", rows, heads, ids)`` as rows are read and, when a table
    is done, ``("texts", heads, texts, stands for)``. A group's head is the number of its first row."""
    found, heads, stands = ContentTable(), [], []
    with tempfile.TemporaryDirectory(dir=spill_folder()) as folder:
        rest = Spill(folder, schema, level)
        for batch in batches:
            ids, texts = batch.column("row").to_pylist(), batch.column("text").to_pylist()
            marks = [int.from_bytes(hashed(text)[:8], "little") for text in texts]
            said = list(zip(*[batch.column(n).to_pylist() for n in STANDS_FOR]))
            seen, seen_heads, seen_ids, left = [], [], [], []
            for k, (row, mark, text) in enumerate(zip(ids, marks, texts)):
                number = found.find(mark, text, found.bytes >= budget)
                if number < 0:
                    left.append(k)
                    continue
                if number == len(heads):
                    heads.append(row)
                    stands.append(said[k])
                else:
                    stands[number] = joined(stands[number], said[k])
                seen.append(row)
                seen_heads.append(heads[number])
                seen_ids.append(said[k][1])
            yield "rows", seen, seen_heads, seen_ids
            if left:
                rest.add(batch.take(pa.array(left)), [marks[k] for k in left])
        yield "texts", heads, found.texts, stands
        del found, heads, stands
        for path in rest.close():
            # with no bits of the hash left, tables follow each other over the same file
            yield from groups(_read(path), schema, min(level + 1, LEVELS), budget, hashed)
            os.remove(path)


def joined(one: tuple, other: tuple) -> tuple:
    """What a row says that stands for the rows of both; the larger doc_id stays."""
    keep = max(one, other, key=lambda s: (s[1] is not None, 0 if s[1] is None else s[1], -s[2]))
    return one[0] + other[0], keep[1], keep[2]


def _cut(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts small enough for one Arrow batch."""
    start = size = 0
    for k, text in enumerate(texts):
        if k > start and (size + len(text) > BATCH_BYTES or k - start >= BATCH_ROWS):
            yield start, k
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of the schema with nulls where no column is given."""
    rows = len(next(iter(columns.values())))
    return pa.record_batch([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type)
                            for f in schema], schema=schema)


def first_pass(batches: Iterator[pa.RecordBatch], out: pa.Schema, **limits) -> Iterator[pa.RecordBatch]:
    """A line ``(row, head, keep_id)`` per row, with the row's own id, and a line
    ``(head, text, ...)`` per distinct text."""
    for found in _with_schema(batches, limits):
        if found[0] == "rows":
            yield _batch(out, row=found[1], head=found[2], keep_id=found[3])
        else:
            _, heads, texts, stands = found
            for a, b in _cut(texts):
                yield _batch(out, head=heads[a:b], text=texts[a:b],
                             sha=[content_hash(t) for t in texts[a:b]],
                             **{n: [s[k] for s in stands[a:b]] for k, n in enumerate(STANDS_FOR)})


def last_pass(batches: Iterator[pa.RecordBatch], out: pa.Schema, **limits) -> Iterator[pa.RecordBatch]:
    """A line ``(head, size, keep_id, keep_row, sha)`` for each head that comes in."""
    of: dict[int, list[int]] = {}
    for found in _with_schema(batches, limits):
        if found[0] == "rows":
            for row, head in zip(found[1], found[2]):
                of.setdefault(head, []).append(row)
            continue
        _, heads, texts, stands = found
        for a in range(0, len(heads), BATCH_ROWS):
            lines = [(row, content_hash(text), *said) for head, text, said in zip(
                heads[a:a + BATCH_ROWS], texts[a:a + BATCH_ROWS], stands[a:a + BATCH_ROWS]) for row in of.pop(head)]
            if lines:
                yield _batch(out, **dict(zip(["head", "sha", *STANDS_FOR], map(list, zip(*lines)))))


def _with_schema(batches: Iterator[pa.RecordBatch], limits: dict) -> Iterator[tuple]:
    first = next(batches, None)
    if first is None:
        return

    def every():
        yield first
        yield from batches
    yield from groups(every(), first.schema, **limits)


def _lines(kind) -> StructType:
    """The lines of the first pass; ``kind`` is the doc_id's type."""
    return StructType([*StructType.fromDDL("row bigint, head bigint, text binary, sha binary, size bigint").fields,
                       StructField("keep_id", kind), StructField("keep_row", LongType())])


def copies(docs: DataFrame, budget: int = BUDGET, many: int = MANY, hashed=content_hash) -> DataFrame:
    """``row, doc_id, keep_id, keep_row, group_size, sha`` for every row of ``docs``, which has
    ``row`` (a unique whole number), ``doc_id`` and ``text``."""
    lines, limits = _lines(docs.schema["doc_id"].dataType), {"budget": budget, "hashed": hashed}
    scan = partial(first_pass, out=to_arrow_schema(lines), **limits)
    rows = docs.select(
        "row", F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.lit(1).cast("bigint").alias("size"),
        F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
    found = keep_table(rows.mapInArrow(scan, lines), "copies-first")
    members = found.where("row IS NOT NULL").select("row", "head", F.col("keep_id").alias("doc_id"))
    texts = found.where("row IS NULL").drop("row")
    while True:
        crowded = keep_table(texts.groupBy("sha").agg(F.count("*").alias("heads")).where(F.col("heads") > many)
                             .select("sha", F.ceil(F.col("heads") / many).alias("places")), "copies-crowded")
        if crowded.isEmpty():
            break
        # texts that are left of very many tasks: those rows meet in groups first
        split = keep_table(texts.join(crowded, "sha", "left"), "copies-split")
        place = F.pmod(F.xxhash64("head"), F.col("places"))
        met = keep_table(
            split.where("places IS NOT NULL").withColumn("place", place).repartition("sha", "place")
            .select(F.col("head").alias("row"), "text", *STANDS_FOR).mapInArrow(scan, lines), "copies-met")
        renamed = met.where("row IS NOT NULL").select(F.col("row").alias("head"), F.col("head").alias("next"))
        members = keep_table(members.join(renamed, "head", "left").select(
            "row", F.coalesce("next", "head").alias("head"), "doc_id"), "copies-members")
        texts = split.where("places IS NULL").drop("places").unionByName(met.where("row IS NULL").drop("row"))

    out = StructType([lines["head"], lines["sha"], *[lines[n] for n in STANDS_FOR]])
    merged = texts.repartition("sha").select(F.col("head").alias("row"), "text", *STANDS_FOR) \
        .mapInArrow(partial(last_pass, out=to_arrow_schema(out), **limits), out)
    merged = keep_table(merged, "copies-groups")
    return members.join(merged, "head").select(
        "row", "doc_id", "keep_id", "keep_row", F.col("size").alias("group_size"), "sha")


def exact_duplicates(docs: DataFrame, **limits) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return copies(rows, **limits).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents with one row of each text, all their columns as they were."""
    rows = keep_table(docs.select(F.monotonically_increasing_id().alias("row"),
                                  F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("whole")), "copies-whole")
    stays = copies(rows.select("row", "whole.doc_id", "whole.text")).where("row = keep_row").select("row")
    return rows.join(stays, "row", "left_semi").select("whole.*")


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


ORACLE = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(text) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY text)
"""
