"""Keyed cell tables in bulk: put, get and delete over a cell log.

A log row is one put of one cell, or a deletion of a whole row (column and value null). The
latest put of a cell counts unless its row was deleted later. ``seq`` gives the order and is
unique per row key; writing the same log row twice changes nothing. All reads are one
aggregation with partial sums, so a row key with very many log rows is no problem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickflow.functions.text import to_text
from clickflow.operators.buckets import BucketTable
from clickflow.schemas import CELL_LOG

PUT, DELETE = "put", "delete"


def _log(rows: DataFrame, family: str, column: Column, value: Column, op: str) -> DataFrame:
    return rows.select(
        to_text("rowkey").alias("rowkey"), F.lit(family).alias("family"),
        column.cast("string").alias("column"), value.cast("string").alias("value"),
        F.col("seq").cast("bigint").alias("seq"), F.lit(op).alias("op"))


def put_cells(rows: DataFrame, column: str, family: str = "info") -> DataFrame:
    """Log rows for single-column puts of ``(rowkey, value, seq)``; null keys or values are none."""
    usable = F.col("rowkey").isNotNull() & F.col("value").isNotNull()
    return _log(rows.where(usable), family, F.lit(column), F.col("value"), PUT)


def _whole(values: str) -> Column:
    """Whether a put can be carried out: it has a key, at least one column and no null."""
    no_null = ~F.exists(F.map_values(values), lambda v: v.isNull())
    return F.coalesce(
        F.col("rowkey").isNotNull() & (F.size(values) > 0) & no_null, F.lit(False))


def put_rows(rows: DataFrame, values: str = "values", family: str = "info") -> DataFrame:
    """Log rows for multi-column puts of ``(rowkey, values map, seq)``.

    A put with a null value is left out as a whole; ``rejected_puts`` gives those.
    """
    spread = rows.where(_whole(values)).select(
        "rowkey", "seq", F.explode(values).alias("_column", "_value"))
    return _log(spread, family, F.col("_column"), F.col("_value"), PUT)


def rejected_puts(rows: DataFrame, values: str = "values") -> DataFrame:
    return rows.where(~_whole(values))


def delete_rows(rows: DataFrame, family: str = "info") -> DataFrame:
    """Log rows that delete whole rows, all columns, from ``(rowkey, seq)``."""
    nothing = F.lit(None)
    return _log(rows.where(F.col("rowkey").isNotNull()), family, nothing, nothing, DELETE)


def current_cells(log: DataFrame) -> DataFrame:
    """The visible cells: the latest put of each, where no later deletion hides it.

    One pass over the log: deletions are the group without a column, and a row's window spreads
    their time over its cells, which are as many as the row has columns.
    """
    put = F.when(F.col("op") == PUT, F.col("seq"))
    deleted = F.max(F.when(F.col("op") == DELETE, F.col("seq")))
    latest = log.groupBy("rowkey", "family", "column").agg(
        F.max_by("value", put).alias("value"), F.max(put).alias("seq"), deleted.alias("_gone"))
    row = Window.partitionBy("rowkey", "family")
    return (
        latest.withColumn("_gone", F.max("_gone").over(row))
        .where(F.col("seq").isNotNull() & (F.col("_gone").isNull() | (F.col("seq") > F.col("_gone"))))
        .drop("_gone")
    )


def _asked_for(log: DataFrame, keys: DataFrame) -> DataFrame:
    """The log rows of the wanted row keys; Spark picks the join by what both sides weigh."""
    return log.join(keys.select("rowkey").distinct(), "rowkey", "left_semi")


def get_cell(requests: DataFrame, log: DataFrame, family: str = "info") -> DataFrame:
    """One value per request ``(rowkey, column)``; missing and empty cells give ``""``."""
    wanted = _asked_for(log.where(F.col("family") == family), requests)
    cells = current_cells(wanted).select("rowkey", "column", "value")
    return (
        requests.join(cells, ["rowkey", "column"], "left")
        .withColumn("value", F.coalesce("value", F.lit("")))
    )


def get_row(keys: DataFrame, log: DataFrame, columns: list[str],
            family: str = "info") -> DataFrame:
    """A map of the wanted columns per row key; missing and empty cells are not in it."""
    mine = _asked_for(log.where(F.col("family") == family), keys)
    mine = mine.where((F.col("op") == DELETE) | F.col("column").isin(columns))
    latest = [
        F.max_by(F.struct("seq", "value"),
                 F.when((F.col("op") == PUT) & (F.col("column") == name), F.col("seq")))
        .alias(f"_c{i}")
        for i, name in enumerate(columns)
    ]
    gone = F.max(F.when(F.col("op") == DELETE, F.col("seq"))).alias("_gone")
    rows = mine.groupBy("rowkey").agg(gone, *latest)
    pairs = []
    for i, name in enumerate(columns):
        cell = F.col(f"_c{i}")
        shown = F.col("_gone").isNull() | (cell["seq"] > F.col("_gone"))
        pairs += [F.lit(name), F.when(shown, cell["value"])]
    values = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull() & (v != ""))
    return (
        keys.join(rows.select("rowkey", values.alias("values")), "rowkey", "left")
        .withColumn("values", F.coalesce("values", F.map_from_arrays(
            F.array().cast("array<string>"), F.array().cast("array<string>"))))
    )


def folded_log(log: DataFrame) -> DataFrame:
    """A log that says the same in one row per visible cell and one per deleted row key.

    Deletions stay, since puts from before them may yet arrive. Needs ``slot`` and ``shard``, and no
    exchange where the log lies by slot.
    """
    key = ["slot", "shard", "rowkey", "family"]
    put = F.when(F.col("op") == PUT, F.col("seq"))
    latest = log.groupBy(*key, "column").agg(
        F.max_by("value", put).alias("value"), F.max(put).alias("_put"),
        F.max(F.when(F.col("op") == DELETE, F.col("seq"))).alias("_deleted"))
    gone = F.max("_deleted").over(Window.partitionBy(*key))
    hidden = F.col("_put").isNotNull() & F.col("_gone").isNotNull() & (F.col("_put") <= F.col("_gone"))
    return latest.withColumn("_gone", gone).where(~hidden).select(
        "rowkey", "family", "column", "value", F.coalesce("_put", "_deleted").alias("seq"),
        F.when(F.col("_put").isNull(), DELETE).otherwise(PUT).alias("op"), "slot", "shard")


class CellTable:
    """A cell log kept as a table bucketed and sorted by row key.

    A write is a batch of its own; name the batch to replace what it wrote before. Reads of some row
    keys prune the table to the buckets these are in.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.path = path
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CELL_LOG)
        self.table = BucketTable(spark, path, schema, ["rowkey"], buckets)

    def log(self) -> DataFrame:
        return self.table.rows().select(*CELL_LOG.names)

    def log_of(self, keys: DataFrame) -> DataFrame:
        """The log of the buckets that hold some row keys, and of some other row keys in them."""
        return self.table.rows(self.table.touched(keys, "rowkey")).select(*CELL_LOG.names)

    def point_log(self, *rowkeys: str) -> DataFrame:
        """The log of a few named row keys; the files are searched by slot and row key."""
        named = self.table.spark.createDataFrame([(k,) for k in rowkeys], "rowkey string")
        return self.log_of(named).where(F.col("rowkey").isin(*rowkeys))

    def write(self, log_rows: DataFrame, batch_id: int | None = None) -> None:
        number = self.table.last_batch() + 1 if batch_id is None else batch_id
        self.table.append(log_rows.select(*CELL_LOG.names), number)

    def fold(self, upto: int | None = None, most: int = 1) -> list[int]:
        """Folds buckets of more than ``most`` batches, of those that will not be written again."""
        return self.table.fold(self.table.last_batch() if upto is None else upto, folded_log, most)


def open_table(spark: SparkSession, path: str, buckets: int | None = None) -> CellTable:
    """The table at a path, made empty if it is not there."""
    return CellTable(spark, path, buckets)
