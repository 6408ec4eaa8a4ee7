"""Hard negatives by exact inner products, scored with the method of Four Russians.

Vectors are whole numbers (components times ``SCALE``, rounded down). Eight dimensions make a
group. For each anchor and group a table holds the sums of all 256 subsets of the anchor's eight
components. A candidate is stored as bit planes: for each bit of its components (in two's complement)
and each group one byte that says which of the eight have it. A byte is an index into the anchor's
table, so a score takes one lookup per bit and group; the sums of the planes are shifted and added,
the highest one, the sign, is subtracted. Scores are exact and full: no candidate is left out.

The rows are dealt evenly into blocks, whatever their labels and ids are, and every anchor goes to
every block, so each task packs the bit planes of its block once and lets the anchors pass by in
Arrow batches. A first pass scores an anchor against the rows of its own label, a second one against
the others, with the ranges its positives give. From a block an anchor takes along its best few rows
only; the best of these over all blocks are found by a window per anchor. The work is the number of
anchors times that of rows, as any exact answer for all rows needs; tables and blocks in memory are
bounded, and nothing is broadcast or collected.

Defined results: rows take no part whose id, label or vector is null, or whose vector has a null,
infinite or undefined component. Vectors of different lengths are compared as if the shorter one ended in
zeros; an empty one scores 0 with all. Repeated rows (same id, label and components) count once; rows
with the same id that differ otherwise are different rows. Equal scores are ordered by id, then by
label and components. Anchors without positives, and positives without rows in their range, give no rows.
Where components are so large that a score may not fit 64 bits, the query stops with a message. An
empty table gives no rows; columns other than the three named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from clickflow.llm.common import keep_table, table

SCALE = 256
GROUP = 8
LARGEST = (1 << 31) - 1  # larger components count as this, and are refused
LEAST_ROWS, MOST_ROWS = 1 << 11, 1 << 16  # of a block
TILE = 64  # anchors scored at once
STRETCH = 1 << 12  # candidates scored at once

FOUND = "anchor bigint, bound bigint, row bigint, id bigint, score bigint"


def subset_sums(anchors: np.ndarray, kind) -> np.ndarray:
    """For each group and anchor the sums of all subsets of its eight components."""
    count, dims = anchors.shape
    sums = np.zeros((dims // GROUP, count, 1 << GROUP), kind)
    grouped = anchors.reshape(count, dims // GROUP, GROUP).transpose(1, 0, 2)
    for k in range(GROUP):
        sums[:, :, 1 << k:2 << k] = sums[:, :, :1 << k] + grouped[:, :, k:k + 1]
    return sums


def bit_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """For each bit and group the candidates' bytes, of two's complement components."""
    count, dims = vectors.shape
    packed = np.empty((planes, dims // GROUP, count), np.uint8)
    for plane in range(planes):
        bits = (vectors >> plane & 1).astype(np.uint8)
        packed[plane] = np.packbits(bits, axis=1, bitorder="little").T
    return packed


def inner_products(sums: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """The exact scores of all anchors with all candidates, if they fit the sums' type; sums on the
    way may wrap round."""
    scores = np.empty((sums.shape[1], packed.shape[2]), sums.dtype)
    for start in range(0, packed.shape[2], STRETCH):
        some = packed[:, :, start:start + STRETCH].astype(np.intp)
        total = np.zeros((sums.shape[1], some.shape[2]), sums.dtype)
        for plane in range(len(some) - 1, -1, -1):
            total <<= 1
            for group, index in enumerate(some[plane]):
                looked_up = np.take(sums[group], index, axis=1)
                if plane == len(some) - 1:
                    total -= looked_up
                else:
                    total += looked_up
        scores[:, start:start + STRETCH] = total
    return scores


def best(scores: np.ndarray, order: np.ndarray, chosen: np.ndarray, most: int) -> np.ndarray:
    """Of the chosen candidates the ``most`` with the highest score, then the lowest order."""
    if len(chosen) > most:
        among = scores[chosen]
        chosen = chosen[among >= np.partition(among, len(among) - most)[len(among) - most]]
    return chosen[np.lexsort((order[chosen], -scores[chosen]))][:most]


class Block:
    """A block's candidates, sorted by label."""

    def __init__(self, batches: list[pa.RecordBatch], planes: int, dims: int):
        rows = pa.Table.from_batches(batches)
        self.row, self.id = rows["row"].to_numpy(), rows["id"].to_numpy()
        self.packed = bit_planes(dense(rows["vector"].combine_chunks(), dims), planes)
        self.order = np.empty(len(self.row), np.int64)
        self.order[np.lexsort((self.row, self.id))] = np.arange(len(self.row))
        self.label = rows["label"].to_numpy()

    def of(self, label) -> slice:
        return slice(*np.searchsorted(self.label, [label, label + 1]))


def dense(vectors: pa.ListArray, dims: int) -> np.ndarray:
    """The vectors as rows of a matrix, ending in zeros."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), values.dtype)
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def _pieces(batches: Iterator[pa.RecordBatch], planes: int, dims: int) -> Iterator[tuple[Block, pa.RecordBatch]]:
    """Each block with batches of the anchors that follow it."""
    held, block, now = [], None, None
    for batch in batches:
        blocks, asks = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("block", "asks"))
        edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1])) + 1
        for start, end in zip([0, *edges], [*edges, len(blocks)]):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            if not asks[start]:
                held = held + [part] if blocks[start] == now else [part]
                block, now = None, blocks[start]
            elif blocks[start] == now:
                block = block or Block(held, planes, dims)
                held = []
                yield block, part


def scan(batches: Iterator[pa.RecordBatch], planes: int, dims: int, kind: str, most: int, limits,
         out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """From each block each anchor's best rows: of its own label, or, with ``limits``, for each of its
    bounds those of other labels whose score is in the bound's range."""
    for block, anchors in _pieces(batches, planes, dims):
        names, vectors = anchors.column("row").to_numpy(), dense(anchors.column("vector"), dims)
        labels, bounds = anchors.column("label").to_numpy(), anchors.column("bounds").to_pylist()
        edges = np.flatnonzero(labels[1:] != labels[:-1]) + 1 if limits is None else []
        found = []
        for start, end in zip([0, *edges], [*edges, len(names)]):
            part = block.of(labels[start]) if limits is None else slice(0, len(block.row))
            rows, ids, order, others = block.row[part], block.id[part], block.order[part], block.label[part]
            for tile in range(start, end, TILE):
                tile_end = min(tile + TILE, end)
                scores = inner_products(subset_sums(vectors[tile:tile_end], kind), block.packed[:, :, part])
                for k in range(tile, tile_end):
                    of_one = scores[k - tile]
                    if limits is None:
                        places = best(of_one, order, np.flatnonzero(rows != names[k]), most)
                        found.append((np.full(len(places), names[k]), np.zeros(len(places), np.int64),
                                      rows[places], ids[places], of_one[places]))
                        continue
                    foreign = others != labels[k]
                    for bound in bounds[k]:
                        least, largest = -(-limits[0] * bound // 100), limits[1] * bound // 100
                        if least > largest:
                            continue
                        places = best(of_one, order, np.flatnonzero(
                            foreign & (of_one >= least) & (of_one <= largest)), most)
                        found.append((np.full(len(places), names[k]), np.full(len(places), bound),
                                      rows[places], ids[places], of_one[places]))
        if found:
            yield pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found)], schema=out)


def scored(rows: DataFrame, anchors: DataFrame, blocks: int, planes: int, dims: int, kind: str, most: int,
           limits: tuple[int, int] | None = None) -> DataFrame:
    """What ``scan`` finds, over all blocks; the best ``most`` for each anchor and bound."""
    columns = ["block", "asks", "row", "id", "label", "vector", "bounds"]
    candidates = rows.withColumns({
        "block": F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"), "asks": F.lit(False),
        "bounds": F.array().cast("array<bigint>")}).select(columns)
    asking = anchors.withColumns({
        "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "asks": F.lit(True)}).select(columns)
    schema = StructType.fromDDL(FOUND)
    found = candidates.union(asking).repartition(blocks, "block").sortWithinPartitions(
        "block", "asks", "label", "row").mapInArrow(partial(
            scan, planes=planes, dims=dims, kind=kind, most=most, limits=limits, out=to_arrow_schema(schema)), schema)
    place = F.row_number().over(Window.partitionBy("anchor", "bound").orderBy(F.desc("score"), "id", "row"))
    return found.withColumn("place", place).where(F.col("place") <= most)


def taking_part(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``row, id, label, vector`` of the rows with an id, a label and finite components, numbered in the
    order of their ids, labels and components; ``vector`` holds whole numbers."""
    fine = "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    whole = f"transform(vector, x -> CAST(least(greatest(floor({scale} * CAST(x AS DOUBLE)), " \
            f"-{LARGEST}L), {LARGEST}L) AS INT))"
    return rows.select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), "vector") \
        .where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(fine) \
        .select("id", "label", F.expr(whole).alias("vector")).distinct()


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``id``, ``label`` (whole numbers) and ``vector``; ``is_anchor`` is a condition on ``id``.
    An anchor's positives are its ``positives`` best other rows of its label, and for each of them the
    ``negatives`` best rows of other labels with a score of ``low`` to ``high`` percent of the positive's
    are returned.
    """
    # Sorted by what tells rows apart, so that their numbers decide the order of equal scores and ids.
    numbered = taking_part(rows).sort("id", "label", "vector").withColumn("row", F.monotonically_increasing_id())
    rows = keep_table(numbered, "mining-rows")
    count, largest, longest = rows.agg(
        F.count("*"), F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))),
        F.max(F.size("vector"))).first()
    largest, dims = largest or 0, max(1, -(-(longest or 0) // GROUP)) * GROUP
    if dims * largest ** 2 >= 1 << 63:
        raise ValueError(f"components up to {largest} after scaling: scores may not fit 64 bits")
    per_block = min(MOST_ROWS, max(LEAST_ROWS, count // (2 * rows.sparkSession.sparkContext.defaultParallelism)))
    shape = {"blocks": max(1, -(-count // per_block)), "planes": int(largest).bit_length() + 1, "dims": dims,
             "kind": "i4" if dims * largest ** 2 < 1 << 31 else "i8"}

    anchors = rows.where(is_anchor)
    near = scored(rows, anchors.withColumn("bounds", F.array().cast("array<bigint>")), most=positives, **shape)
    near = keep_table(near.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                                  F.col("place").alias("positive")), "mining-positives")
    bounds = near.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("positive_score").alias("bounds"))
    far = scored(rows, anchors.join(bounds, "row"), most=negatives, limits=(low, high), **shape)
    named = near.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.join(far.select("anchor", F.col("bound").alias("positive_score"), F.col("place").alias("rank"),
                                 F.col("id").alias("negative_id"), F.col("score").alias("negative_score")),
                      ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label"),
        F.col("embedding").alias("vector"))
    return hard_negatives(rows, F.col("id") % 100 == 0)


ORACLE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, other_id AS negative_id,
       positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER best <= 10
"""
