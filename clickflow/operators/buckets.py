"""Keyed tables grown batch by batch, bucketed and sorted, so that a lookup costs what it touches.

Every key has a slot, a hash of it; slots are dealt over the table's buckets and rows are sorted by
slot within a bucket's files. Given the slots it needs, a query reads those buckets only (bucket
pruning), in them the row groups that hold the slots, and a join or aggregation on the slot needs
no exchange above the scan. The list of slots is bounded by ``SLOTS`` per bucket, whatever the data.

A batch writes one file per bucket it touches, in a partition of its own, and replaces it when
replayed. Folding goes bucket by bucket: only buckets with many batches are read and written again.
A fold is written as the partition of the last batch in it, and rows stay true when they are read
beside what they were folded from, so nothing has to happen at once: files a fold stands for are
deleted at the next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickflow.operators.batchlog import delete_folder, folder_names, partition_folders, read_if_there
from clickflow.session import setting

SLOTS = 16  # per bucket

# Buckets with more batches than this are folded.
BATCHES = 8

LAYOUT = "slot int, shard int, batch_id bigint"


class BucketTable:
    """Rows of ``schema`` by their ``key`` columns, below a folder.

    The number of buckets is chosen once, by default as many as the session has shuffle partitions,
    and is part of the folder's name.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: list[str],
                 buckets: int | None = None):
        self.spark, self.schema, self.key = spark, schema, key
        found = [n for n in folder_names(spark, folder) if n.startswith("buckets-")]
        self.buckets = int(found[0].split("-")[1]) if found else buckets or int(
            spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = f"{folder.rstrip('/')}/buckets-{self.buckets}"
        self.folds = f"{folder.rstrip('/')}/folds"
        self._by_slot: list[int] | None = None
        self.name = f"clickflow_{hashlib.md5(self.folder.encode()).hexdigest()}"
        # partitions are found by their folders, whatever catalog the session has
        with setting(spark, spark__sql__hive__manageFilesourcePartitions="false"):
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}, {LAYOUT}) USING parquet "
                f"PARTITIONED BY (shard, batch_id) CLUSTERED BY (slot) SORTED BY (slot, {', '.join(key)}) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.folder}'")

    def slot(self, *key: str) -> Column:
        """The slot of a key, by default of the table's own key columns."""
        return F.pmod(F.xxhash64(*(key or self.key)), F.lit(self.buckets * SLOTS)).cast("int")

    def _shard(self, slot: Column | str) -> Column:
        """The bucket Spark puts a slot into."""
        return F.pmod(F.hash(slot), F.lit(self.buckets))

    def touched(self, keys: DataFrame, *key: str) -> list[int]:
        """The slots of some keys: at most ``SLOTS`` numbers per bucket."""
        return [r[0] for r in keys.select(self.slot(*key)).distinct().collect()]

    def _shards_of(self, slots: list[int]) -> set[int]:
        if self._by_slot is None:
            every = self.spark.range(self.buckets * SLOTS).select(self._shard(F.col("id").cast("int"))).collect()
            self._by_slot = [r[0] for r in every]
        return {self._by_slot[slot] for slot in slots}

    def rows(self, slots: list[int] | None = None, before: int | None = None) -> DataFrame:
        """All rows, or those in some slots, of all batches or of those before one; with ``slot``,
        ``shard`` and ``batch_id``."""
        self.spark.catalog.refreshTable(self.name)  # another session may have written
        rows = self.spark.table(self.name)
        if slots:
            shards = ", ".join(map(str, sorted(self._shards_of(slots))))
            rows = rows.where(f"slot IN ({', '.join(map(str, slots))}) AND shard IN ({shards})")
        elif slots is not None:
            rows = rows.where("false")
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Writes a batch's rows, in place of those it wrote before."""
        self._write(rows.withColumn("slot", self.slot()).withColumn("shard", self._shard("slot"))
                    .repartition(self.buckets, "slot"), batch_id)

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        columns = self.spark.table(self.name).columns
        with setting(rows.sparkSession, spark__sql__sources__partitionOverwriteMode="dynamic"):
            rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*columns) \
                .write.mode("overwrite").insertInto(self.name)

    def batches(self) -> dict[int, list[int]]:
        """The batches that each bucket has files of."""
        found: dict[int, list[int]] = {}
        for shard, batch in partition_folders(self.spark, self.folder, "shard", "batch_id"):
            found.setdefault(int(shard), []).append(int(batch))
        return found

    def last_batch(self) -> int:
        """The highest batch there is, -1 without any."""
        return max((max(b) for b in self.batches().values()), default=-1)

    def fold(self, upto: int, merge: Callable[[DataFrame], DataFrame], most: int = 1) -> list[int]:
        """Merges the batches up to and including ``upto`` of the buckets that have more than ``most``.

        ``merge`` turns a bucket's rows, with ``slot, shard, batch_id``, into fewer that say the same,
        with ``slot`` and ``shard``. Only fold batches that can no longer be replayed.
        """
        self._drop_folded()
        full = [s for s, batches in self.batches().items() if sum(b <= upto for b in batches) > most]
        if full:
            rows = self.rows().where(F.col("shard").isin(full) & (F.col("batch_id") <= upto))
            self._write(merge(rows), upto)
            self.spark.createDataFrame([(s, upto) for s in full], "shard int, upto bigint") \
                .coalesce(1).write.mode("append").parquet(self.folds)
        return full

    def _drop_folded(self) -> None:
        """Deletes the files that earlier folds stand for."""
        folds = read_if_there(self.spark, self.folds, "shard int, upto bigint")
        newest = dict(folds.groupBy("shard").agg(F.max("upto")).collect())  # at most one line per bucket
        for shard, batches in self.batches().items():
            for batch in batches:
                if batch < newest.get(shard, -1):
                    delete_folder(self.spark, f"{self.folder}/shard={shard}/batch_id={batch}")
