"""MinHash near-duplicates by an LSH forest: sorted signature orders and prefix neighbours.

A text is the set of its distinct 5-word shingles. Texts with equal sets are one node. Every
node has ``VALUES`` minimum hashes; each of ``TREES`` trees reads them in an order of its own
and sorts all nodes by them. In a sorted order, nodes that share at least ``START`` values are
a region:

* in a region of up to ``REGION`` nodes all pairs are candidates;
* in a larger one the depth adapts: each node meets its ``NEAR`` next neighbours, which are the
  ones with the longest common prefix, and at each of the depths ``PIVOT_DEPTHS`` every node of
  a part that is still large meets the ``PIVOTS`` nodes in its middle, those with most values
  in common with the part's most frequent ones. So an original that thousands of edited copies
  link to only by itself is met by all of them, and a region of n nodes gives some n candidates
  and not n * n.

Candidates must meet in two trees at least, or once with ``DEEP`` values in common. They are
confirmed on the full sets, first each node's best ones and those with pivots, then all that lead
from one component to another; links inside a component cannot change the result any more.

What large regions then hold besides their main components is looked at in families. Nodes of a
region whose whole signatures agree in ``LOOSE_AGREE`` of the values, so that their texts may be
similar, belong to one family; a region tells of each node one other node that it belongs with, so
families of any size cost a row per node and tree. Each family with more than one component is
then worked off by its full sets: the nodes outside its most frequent component are compared with
all nodes of the family, in blocks of ``BLOCK_SHINGLES``, by counting common shingles exactly. A block
gives only links that join components, never the pairs it compared. Sets travel once per node, and
those that ask once per block. Comparing a family with itself grows with the product of its size
and the number of its nodes outside the main component, spread over its blocks.

A pair at similarity 0.75 shares three values in a tree with probability 0.42, so it misses two
of 24 trees with probability 3.5e-5.

Defined results: letters A-Z are lower-cased, words are split at blanks and ASCII line and tab
characters; a text with fewer words than five is one shingle; a null or wordless text has none
and is linked with nothing; repeated rows are alike and get the same component; null doc_ids
count as larger than all others. Very long texts are taken whole. An empty table gives no rows. Only
``doc_id`` (of any type that can be ordered) and ``text`` are read; ``one_of_each`` gives back every
column, whatever its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StructType

from clickflow.llm.common import BROADCAST_ROWS, LOWER_TABLE, keep_table, small_side, table, text_batches

SHINGLE = 5
LEAST_PERCENT = 75
TREES, START, DEPTH = 24, 3, 12
VALUES = TREES * START
REGION, NEAR, PIVOTS = 16, 2, 1
PIVOT_DEPTHS = (3, 6)
DEEP = 6
LOOSE_AGREE, BLOCK_SHINGLES = 0.55, 1_000_000
ROWS_PER_TASK = 200_000

_random = np.random.default_rng(75)
MIX = _random.integers(0, 2 ** 63, VALUES, dtype=np.uint64)
ODD = _random.integers(0, 2 ** 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tree_orders() -> np.ndarray:
    """For each tree its own START values first, then others in a fixed random order."""
    orders = []
    for tree in range(TREES):
        own = np.arange(tree * START, (tree + 1) * START)
        others = np.random.default_rng(tree).permutation(np.setdiff1d(np.arange(VALUES), own))
        orders.append(np.concatenate([own, others[:DEPTH - START]]))
    return np.array(orders)


ORDERS = tree_orders()


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    if not text:
        return np.empty(0, np.uint64)
    words = text.translate(LOWER_TABLE).encode("utf-8", "replace").split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = min(size, len(words)) - 1
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter(
        (digest(joined[a:b]) for a, b in zip(starts.tolist(), ends[last:].tolist())), np.uint64,
        len(words) - last))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The low 16 bits of each minimum hash."""
    least = np.full(VALUES, 2 ** 32 - 1, np.uint64)
    for k in range(0, len(hashes), 1024):
        block = ((hashes[None, k:k + 1024] ^ MIX[:, None]) * ODD[:, None]) >> np.uint64(32)
        np.minimum(least, block.min(axis=1), out=least)
    return (least & np.uint64(0xFFFF)).astype(np.uint16)


def sign_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            hashes = shingle_hashes(text)
            rows.append((len(hashes), xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None,
                         signature(hashes).tobytes() if len(hashes) else None))
        signed = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
            (pa.int64(), pa.binary(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *signed],
                                         ["doc_id", "text_key", "n_shingles", "node", "sig"])


def tree_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each node once per tree with its key, the values in the tree's order."""
    for part in parts:
        if not len(part):
            continue
        values = np.frombuffer(b"".join(part["sig"]), np.uint16).reshape(-1, VALUES)
        for tree, order in enumerate(ORDERS):
            keys = np.ascontiguousarray(values[:, order].astype(">u2"))
            yield pd.DataFrame({"tree": np.int16(tree), "key": [k.tobytes() for k in keys],
                                "node": part["node"]})


def _spans(cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs between cuts; cut[i] stands between rows i and i + 1."""
    edges = np.flatnonzero(cut) + 1
    return np.concatenate([[0], edges]), np.concatenate([edges, [len(cut) + 1]])


def prefix_neighbours(tree: np.ndarray, key: np.ndarray):
    """Candidate row pairs of sorted tree rows: ``(left, right, weight, pivot, large)``."""
    n = len(tree)
    if n < 2:
        return
    same = (key[1:] == key[:-1]) & (tree[1:] == tree[:-1])[:, None]
    common = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    starts, ends = _spans(common < START)
    sizes = ends - starts
    region = np.repeat(np.arange(len(starts)), sizes)
    large = sizes[region] > REGION
    for off in range(1, REGION):
        left = np.flatnonzero(region[:-off] == region[off:]) if off < n else np.empty(0, int)
        if off > NEAR:
            left = left[~large[left]]
        if len(left):
            deep = (key[left, :DEEP] == key[left + off, :DEEP]).all(axis=1)
            yield left, left + off, np.where(deep, 2, 1), np.zeros(len(left), bool), large[left]
    for depth in PIVOT_DEPTHS:
        starts, ends = _spans(common < depth)
        for k in np.flatnonzero(ends - starts > REGION):
            rows = np.arange(starts[k], ends[k])
            part = key[rows]
            agree = np.zeros(len(rows), int)
            for level in range(depth, DEPTH):
                values, back, counts = np.unique(part[:, level], return_inverse=True, return_counts=True)
                agree += back == counts.argmax()
            for pivot in rows[np.argsort(-agree, kind="stable")[:PIVOTS]]:
                others = rows[rows != pivot]
                yes = np.ones(len(others), bool)
                yield np.full(len(others), pivot), others, np.full(len(others), 1 + (depth >= DEEP)), yes, yes


def scan_orders(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidate pairs from one range of the sorted orders; the range's size is bounded."""
    frames = [p for p in parts if len(p)]
    if not frames:
        return
    rows = pd.concat(frames, ignore_index=True)
    node = rows["node"].to_numpy()
    key = np.frombuffer(b"".join(rows["key"]), ">u2").reshape(-1, DEPTH)
    for left, right, weight, pivot, large in prefix_neighbours(rows["tree"].to_numpy(), key):
        # the pivot stays first, so that a hub's set is joined while its rows are narrow
        first = np.where(pivot | (node[left] < node[right]), node[left], node[right])
        second = np.where(pivot | (node[left] < node[right]), node[right], node[left])
        for k in range(0, len(first), 50_000):
            yield pd.DataFrame({"a": first[k:k + 50_000], "b": second[k:k + 50_000],
                                "weight": weight[k:k + 50_000].astype(np.int32),
                                "pivot": pivot[k:k + 50_000], "large": large[k:k + 50_000]})


def labelled_tree_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        for rows in tree_rows([part]):
            yield rows.assign(label=part["label"], sig=part["sig"])


class Joined:
    """Which of numbered things belong together; the smallest number names them."""

    def __init__(self, count: int):
        self.up = list(range(count))

    def find(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = k = self.up[self.up[k]]
        return k

    def join(self, a: int, b: int) -> bool:
        """Whether they did not belong together before."""
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
        return a != b


def scan_families(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In the regions of crowded nodes pairs ``a, b`` that join all components with similar signatures:
    one pair less than there are components at most."""
    frames = [p for p in parts if len(p)]
    if not frames:
        return
    rows = pd.concat(frames, ignore_index=True)
    tree, node = rows["tree"].to_numpy(), rows["node"].to_numpy()
    key = np.frombuffer(b"".join(rows["key"]), ">u2").reshape(-1, DEPTH)
    sig = np.frombuffer(b"".join(rows["sig"]), np.uint16).reshape(-1, VALUES)
    label = pd.factorize(rows["label"])[0]
    cut = (key[1:, :START] != key[:-1, :START]).any(axis=1) | (tree[1:] != tree[:-1])
    for start, end in zip(*_spans(cut)):
        inside, labels = sig[start:end], np.unique(label[start:end], return_inverse=True)[1]
        sizes = np.bincount(labels)
        if len(sizes) < 2:
            continue
        rest = np.flatnonzero(labels != sizes.argmax())
        joined, found = Joined(len(sizes)), []
        block = max(1, 500_000 // (end - start))
        for k in range(0, len(rest), block):
            asks = rest[k:k + block]
            agree = (inside[asks][:, None, :] == inside[None, :, :]).sum(axis=2, dtype=np.int16)
            for one, row in zip(asks.tolist(), agree >= LOOSE_AGREE * VALUES):
                others = np.flatnonzero(row)
                for name, at in zip(*np.unique(labels[others], return_index=True)):
                    if joined.join(int(labels[one]), int(name)):
                        found.append((node[start + one], node[start + others[at]]))
        if found:
            yield pd.DataFrame(found, columns=["a", "b"])


class Sets:
    """The sets of a block of nodes, for counting what another set has in common with each."""

    def __init__(self, rows: pd.DataFrame):
        self.node, self.label = rows["node"].to_numpy(), rows["label"].to_numpy()
        sets = [np.frombuffer(h, np.uint64) for h in rows["hashes"]]
        self.size = np.array([len(s) for s in sets])
        self.starts = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.known, self.place = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(self.known), np.uint8)

    def similar(self, hashes: np.ndarray) -> np.ndarray:
        """The rows whose sets reach the similarity with another."""
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        at = at[self.known[at] == hashes]
        self.mark[at] = 1
        both = np.add.reduceat(self.mark[self.place], self.starts, dtype=np.int64)
        self.mark[at] = 0
        return np.flatnonzero(100 * both >= LEAST_PERCENT * (self.size + len(hashes) - both))


def family_links(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links ``a, b`` that join components, from rows sorted by family and block, with a block's own
    nodes before those that ask."""
    held, now, sets = [], None, None
    for part in parts:
        for (family, block, asks), rows in part.groupby(["family", "block", "asks"], sort=False):
            if now != (family, block):
                held, now, sets = [], (family, block), None
            if not asks:
                held.append(rows)
                continue
            if not held and sets is None:
                continue  # a block without nodes
            if sets is None:
                sets, names, held = Sets(pd.concat(held)), {}, []
                joined = Joined(0)
            found = []
            for node, label, hashes in zip(rows["node"], rows["label"], rows["hashes"]):
                for k in sets.similar(np.frombuffer(hashes, np.uint64)):
                    one, other = (names.setdefault(name, len(names)) for name in (label, sets.label[k]))
                    joined.up.extend(range(len(joined.up), len(names)))
                    if joined.join(one, other):
                        found.append((node, sets.node[k]))
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])


@F.pandas_udf(BooleanType())
def similar(left: pd.Series, right: pd.Series) -> pd.Series:
    """Whether two full sets reach the similarity."""
    found = []
    for a, b in zip(left, right):
        a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        both = len(np.intersect1d(a, b, assume_unique=True))
        found.append(100 * both >= LEAST_PERCENT * (len(a) + len(b) - both))
    return pd.Series(found, dtype=bool)


def set_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        yield pd.DataFrame({"node": part["node"], "hashes": [
            shingle_hashes(t).tobytes() for t in part["text"]]})


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("set_b"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .where(similar("set_a", "set_b")).select("a", "b"))


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``(node, label)`` after joining the labels that edges lead between.

    Edges are taken between labels; on them the smallest label spreads, then each label jumps to
    its label's label, until nothing moves. Nodes follow their label once at the end.
    """
    ends = (edges.join(labels.select(F.col("node").alias("a"), F.col("label").alias("one")), "a")
            .join(labels.select(F.col("node").alias("b"), F.col("label").alias("other")), "b")
            .where("one <> other").select("one", "other"))
    both = keep_table(ends.union(ends.select("other", "one")).distinct(), "dedup-edges")
    names = both.select(F.col("one").alias("name"), F.col("one").alias("now")).distinct()
    while True:
        near = both.join(names.select(F.col("name").alias("other"), "now"), "other") \
            .groupBy(F.col("one").alias("name")).agg(F.min("now").alias("best"))
        spread = keep_table(names.join(near, "name").select(
            "name", F.col("now").alias("old"), F.least("now", "best").alias("now")), "dedup-spread")
        jump = spread.select(F.col("name").alias("now"), F.col("now").alias("up"))
        moved = keep_table(spread.join(jump, "now").select(
            "name", F.least("now", "up").alias("now"), "old"), "dedup-labels")
        names = moved.select("name", "now")
        if moved.where("now < old").isEmpty():
            break
    return keep_table(labels.join(names.withColumnRenamed("name", "label"), "label", "left").select(
        "node", F.coalesce("now", "label").alias("label")), "dedup-joined")


def in_order(rows: DataFrame, count: int) -> DataFrame:
    """Tree rows in their trees' orders, cut into ranges of some ``ROWS_PER_TASK`` whatever the
    cluster; equal keys may be cut apart, too."""
    tasks = max(1, -(-count * TREES // ROWS_PER_TASK))
    order = ("tree", "key", "node")
    return rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def candidates(nodes: DataFrame, count: int) -> DataFrame:
    """Distinct pairs ``(a, b, weight, pivot, large)`` of nodes from all trees."""
    pairs = in_order(nodes.mapInPandas(tree_rows, "tree smallint, key binary, node binary"), count) \
        .mapInPandas(scan_orders, "a binary, b binary, weight int, pivot boolean, large boolean")
    flipped = F.col("a") > F.col("b")
    return pairs.groupBy(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).agg(
        F.sum("weight").alias("weight"), F.max("pivot").alias("pivot"), F.max("large").alias("large"),
        F.max(F.col("pivot") & flipped).alias("turned")) \
        .where("weight >= 2").select(
            F.when(F.col("turned"), F.col("high")).otherwise(F.col("low")).alias("a"),
            F.when(F.col("turned"), F.col("low")).otherwise(F.col("high")).alias("b"),
            "weight", "pivot", "large")


def linked_nodes(docs: DataFrame, signed: DataFrame) -> DataFrame | None:
    """``(node, label)`` for nodes that have candidates, or None where there are none."""
    nodes = keep_table(signed.where("node IS NOT NULL").groupBy("node").agg(
        F.first("sig").alias("sig")), "dedup-nodes")
    pairs = keep_table(candidates(nodes, nodes.count()), "dedup-candidates")
    if pairs.isEmpty():
        return None
    near = keep_table(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(),
                      "dedup-near")
    n_near = near.count()
    chosen = keep_table(signed.join(small_side(near, n_near), "node").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_key")).alias("row")).select("row.*", "node"), "dedup-chosen")
    whole = docs.select(F.col("doc_id").alias("id"), "text", text_key().alias("key"))
    sets = whole.join(small_side(chosen, n_near), F.col("id").eqNullSafe(F.col("doc_id"))
                      & (F.col("key") == F.col("text_key"))).select("node", "text") \
        .groupBy("node").agg(F.first("text").alias("text"))
    sets = keep_table(sets.mapInPandas(set_rows, "node binary, hashes binary"), "dedup-sets")
    best = pairs.select("a", "b", "weight").union(pairs.select("b", "a", "weight")) \
        .groupBy("a").agg(F.max(F.struct("weight", "b"))["b"].alias("b"))
    first = pairs.where("pivot").select("a", "b").union(
        best.select(F.least("a", "b"), F.greatest("a", "b"))).distinct()
    links = keep_table(confirmed(first, sets), "dedup-links")
    labels = components(links, near.select("node", F.col("node").alias("label")))
    rest = (pairs.select("a", "b")
            .join(labels.select(F.col("node").alias("a"), F.col("label").alias("label_a")), "a")
            .join(labels.select(F.col("node").alias("b"), F.col("label").alias("label_b")), "b")
            .where("label_a <> label_b").select("a", "b"))
    more = keep_table(confirmed(rest, sets), "dedup-more")
    if not more.isEmpty():
        labels = components(more, labels)
    crowded = pairs.where("large").select(F.explode(F.array("a", "b")).alias("node")).distinct()
    crowd = keep_table(nodes.join(crowded, "node", "left_semi"), "dedup-crowd")
    return join_rest(crowd, labels, sets)


def join_rest(crowd: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """The labels after the families of large regions were compared by their full sets."""
    labelled = labels.join(crowd, "node")
    loose = keep_table(in_order(labelled.mapInPandas(
        labelled_tree_rows, "tree smallint, key binary, node binary, label binary, sig binary"), crowd.count())
        .mapInPandas(scan_families, "a binary, b binary").distinct(), "dedup-loose")
    if loose.isEmpty():
        return labels
    families = components(loose, labels).withColumnRenamed("label", "family")
    members = keep_table(
        crowd.select("node").join(labels, "node").join(families, "node").join(sets, "node"), "dedup-members")
    # one row per component, then one per family
    parts = members.groupBy("family", "label").agg(
        F.count("*").alias("nodes"), F.sum(F.length("hashes") / 8).alias("shingles"))
    shapes = parts.groupBy("family").agg(
        F.count("*").alias("parts"), F.max_by("label", F.struct("nodes", "label")).alias("main"),
        F.ceil(F.sum("shingles") / BLOCK_SHINGLES).alias("blocks")).where("parts > 1")
    mixed = members.join(shapes, "family")
    own = mixed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("asks", F.lit(False))
    asking = mixed.where("label <> main").withColumn("block", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("blocks") - 1))).withColumn("asks", F.lit(True))
    columns = ["family", "block", "asks", "node", "label", "hashes"]
    links = own.select(columns).union(asking.select(columns)).repartition("family", "block") \
        .sortWithinPartitions("family", "block", "asks").mapInPandas(family_links, "a binary, b binary")
    links = keep_table(links, "dedup-last")
    return labels if links.isEmpty() else components(links, labels)


def text_key():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept, keeper`` for every row of ``docs``.

    ``kept`` says that the row's doc_id is its component's smallest. ``keeper`` is the
    ``(doc_id, text_key)`` of the one row that stands for the component.
    """
    text_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    signed = StructType([docs.schema["doc_id"], *StructType.fromDDL(
        "text_key binary, n_shingles bigint, node binary, sig binary").fields])
    signed = keep_table(docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(sign_texts, signed),
                        "dedup-signed")
    own = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    labels = linked_nodes(docs, signed)
    least = signed.where("node IS NOT NULL").groupBy("node").agg(F.min(own).alias("least"))
    if labels is not None:
        labelled = keep_table(least.join(labels, "node", "left").select(
            "node", "least", F.coalesce("label", "node").alias("label")), "dedup-labelled")
        leasts = labelled.groupBy("label").agg(F.min("least").alias("least"))
        least = labelled.select("node", "label").join(leasts, "label").select("node", "least")
    least = keep_table(least.select(F.col("node").alias("of"), "least"), "dedup-least")
    joined = signed.select("doc_id", "text_key", "n_shingles", "node").join(
        least, F.col("node") == F.col("of"), "left")
    keeper = F.coalesce("least", own)
    return joined.select(
        "doc_id", "text_key", "n_shingles", keeper["doc_id"].alias("component_id"),
        F.col("doc_id").eqNullSafe(keeper["doc_id"]).alias("kept"),
        F.struct(keeper["doc_id"].alias("doc_id"), keeper["text_key"].alias("text_key")).alias("keeper"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one row of each component, all their columns as they were."""
    found = keep_table(near_duplicates(docs), "dedup-found")
    stays = F.col("kept") & F.col("keeper.text_key").eqNullSafe(F.col("text_key"))
    keys = keep_table(found.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(
        F.first(stays).alias("stays"), F.count("*").alias("rows")).where("NOT stays OR rows > 1"), "dedup-goes")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       F.col("doc_id").alias("of"), text_key().alias("text_key"))
    same = F.col("of").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    whole = rows.join(small_side(keys, keys.count()), same, "left_anti").select("row.*")
    several = keys.where("stays")  # the row that stays is there several times
    n_several = several.count()
    if n_several:
        one = rows.join(small_side(several, n_several), same, "left_semi").dropDuplicates(["of", "text_key"])
        whole = whole.union(one.select("row.*"))
    return whole


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
