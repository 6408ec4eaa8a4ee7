"""Whole-table numbering without putting the whole table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickflow.session import keep_table, work_folder

# Numbers per block, and blocks per span. Sequence numbers are unique, so a block holds at most
# so many rows and a span so many blocks; all whole numbers there are make up 2^23 spans.
BLOCK_WIDTH = 1 << 20
SPAN_BLOCKS = 1 << 20


def _sum_before(rows: str, order: str, *group: str) -> Column:
    window = Window.partitionBy(*group).orderBy(order) if group else Window.orderBy(order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(rows).over(before), F.lit(0))


def _start_of(value: str, width: int) -> Column:
    return (F.col(value) - F.pmod(F.col(value), F.lit(width))).cast("bigint")


def number_in_order(df: DataFrame, seq: str, name: str, block_width: int = BLOCK_WIDTH,
                    span_blocks: int = SPAN_BLOCKS) -> DataFrame:
    """Numbers rows 1, 2, 3, ... by a unique whole-number column, dense or not.

    Rows are numbered within blocks of neighbouring values, and each block is moved up by the
    rows in the blocks before it. Those are summed up the same way, within spans of blocks, so
    only one row per span meets in one task. The few block starts are written once; after that
    the rows pass one exchange. Rows without a number stay, take no number and count for none.
    """
    rows = df.withColumn("_block", _start_of(seq, block_width)) \
        .withColumn("_loose", F.when(F.col(seq).isNull(), F.spark_partition_id()))
    counted = df.where(F.col(seq).isNotNull()).select(_start_of(seq, block_width).alias("_block"))
    blocks = counted.groupBy("_block").agg(F.count(F.lit(1)).alias("_rows")).withColumn(
        "_span", _start_of("_block", block_width * span_blocks))
    blocks = keep_table(blocks, "blocks")
    spans = (
        blocks.groupBy("_span").agg(F.sum("_rows").alias("_rows"))
        .select("_span", _sum_before("_rows", "_span").alias("_spanBefore"))
    )
    before = (
        blocks.withColumn("_blockBefore", _sum_before("_rows", "_block", "_span"))
        .join(spans, "_span")
        .select("_block", (F.col("_blockBefore") + F.col("_spanBefore")).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("_block", "_loose").orderBy(seq))
    return (
        rows.withColumn("_within", within)
        .join(before, "_block", "left")
        .withColumn(name, (F.col("_before") + F.col("_within")).cast("bigint"))
        .drop("_block", "_loose", "_within", "_before")
    )


# Rows that one task sorts, about: ranges are cut at quantiles of a sample.
RANGE_ROWS = 1 << 17


def number_by(df: DataFrame, order: list[str], name: str, path: str | None = None,
              range_rows: int = RANGE_ROWS) -> DataFrame:
    """Numbers rows 1, 2, 3, ... in the order of any columns that tell all rows apart.

    The rows are counted, sorted into ranges of about ``range_rows``, one per task, and written. A row's
    number is its place in its range and the rows of the ranges before; only one row per range goes to
    all tasks. Give a ``path`` to write to the same place every time.
    """
    spark, path = df.sparkSession, path or work_folder(df.sparkSession, "in-order")
    at = F.monotonically_increasing_id()  # the range and, in the lower 33 bits, the place in it
    ranges = max(1, -(-df.count() // range_rows))
    ranked = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_at", at)
    ranked.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(ranked.schema).parquet(path)
    place = F.shiftright("_at", 33)
    starts = rows.groupBy(place.alias("_range")).agg(F.count(F.lit(1)).alias("_rows")) \
        .select("_range", _sum_before("_rows", "_range").alias("_before"))
    return (
        rows.withColumn("_range", place).join(F.broadcast(starts), "_range")
        .withColumn(name, (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).cast("bigint"))
        .drop("_at", "_range", "_before")
    )


def round_robin_partition(df: DataFrame, seq: str, partitions: int,
                          name: str = "partition") -> DataFrame:
    """The topic partition each record gets from a counter that restarts after 65536 sends.

    For merely even output use ``df.repartition(n)``, which Spark deals out in turn.
    """
    counter = (F.col("_sent") - 1) % 65536 + 1
    return (
        number_in_order(df, seq, "_sent")
        .withColumn(name, (counter % partitions).cast("int"))
        .drop("_sent")
    )
