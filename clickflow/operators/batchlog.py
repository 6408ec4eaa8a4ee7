"""Tables grown batch by batch, safe to replay, and folded now and then.

Each batch writes its own ``batch_id`` partition and replaces it when replayed, so a restart
never counts twice. Folding sums old batches up into a base under a new name; readers use a
base only once it is listed in the small ``bases`` table, which is written last. What a base
stands for is deleted one fold later, so that readers who began before it can finish.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickflow.session import setting


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at a path, or an empty one if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Writes one batch's partition, replacing it if the batch was written before."""
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id").parquet(path)
    )


def _file_system(spark: SparkSession, path: str):
    """The folder's file system and its path there, whichever storage it is on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; only used on folders with one entry per batch or base."""
    files, where = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def partition_folders(spark: SparkSession, path: str, *names: str) -> list[tuple[str, ...]]:
    """The values of a table's partition columns, from its folders, in one listing."""
    files, where = _file_system(spark, "/".join([path, *[f"{name}=*" for name in names]]))
    found = files.globStatus(where) or []
    return [tuple(part.partition("=")[2] for part in s.getPath().toString().split("/")[-len(names):])
            for s in found]


def delete_folder(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


class BatchLog:
    """Batches of rows below a folder, plus named bases that stand for the older ones."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def append(self, rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, f"{self.folder}/deltas", batch_id)

    def batches(self, after: int = -1, upto: int | None = None) -> DataFrame:
        """Rows of the batches after one and up to another, read from those partitions only."""
        rows = read_if_there(
            self.spark, f"{self.folder}/deltas", f"{self.schema}, batch_id bigint")
        rows = rows.where(F.col("batch_id") > after)
        return rows if upto is None else rows.where(F.col("batch_id") <= upto)

    def folded_up_to(self) -> int:
        """The last batch in the newest base, -1 if there is none."""
        bases = read_if_there(self.spark, f"{self.folder}/bases", "upto bigint")
        newest = bases.agg(F.max("upto")).first()[0]
        return -1 if newest is None else newest

    def base(self, kind: str, upto: int, schema: str) -> DataFrame:
        """One part of the base that ends with a batch; empty for -1."""
        if upto < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{kind}-{upto}")

    def fold(self, upto: int,
             parts: Callable[[int, DataFrame], dict[str, DataFrame]]) -> None:
        """Writes a new base from the old one and the batches up to and including ``upto``.

        Only fold batches the stream can no longer replay: ones before the batch it is at.
        """
        done = self.folded_up_to()
        if upto <= done:
            return
        listed = self.spark.range(1).select(F.lit(upto).cast("bigint").alias("upto"))
        with setting(self.spark, spark__sql__sources__partitionOverwriteMode="static"):
            for kind, rows in parts(done, self.batches(done, upto)).items():
                rows.write.mode("overwrite").parquet(f"{self.folder}/{kind}-{upto}")
            listed.write.mode("append").parquet(f"{self.folder}/bases")

    def drop(self, upto: int) -> None:
        """Deletes the batches a base stands for and the bases before it."""
        for name in folder_names(self.spark, f"{self.folder}/deltas"):
            kind, _, number = name.partition("=")
            if kind == "batch_id" and int(number) <= upto:
                delete_folder(self.spark, f"{self.folder}/deltas/{name}")
        for name in folder_names(self.spark, self.folder):
            kind, _, number = name.partition("-")
            if number and int(number) < upto:
                delete_folder(self.spark, f"{self.folder}/{name}")

    def maintain(self, batch_id: int, every: int, fold: Callable[[int], None]) -> None:
        """At every so many batches, folds all before this one and drops the fold before."""
        if batch_id and batch_id % every == 0:
            done = self.folded_up_to()
            fold(batch_id - 1)
            if 0 <= done < batch_id - 1:
                self.drop(done)
