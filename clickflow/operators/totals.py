"""Running totals, kept as a ledger of per-batch sums.

The stream writes one kind of row: the sums of a channel and hour within a window. All result
tables are sums over those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickflow.operators import metrics
from clickflow.operators.batchlog import BatchLog
from clickflow.session import keep_table

# Per result table its key and its summed columns.
TOTALS = {
    "channel": (["channelId"], ["visited"]),
    "channel_pvuv": (["channelId", "yearMonthDayHour"], ["pv", "uv"]),
    "channel_freshness": (["channelId", "date"], ["newCount", "oldCount"]),
}

FROM_HOURLY = {
    "channel": metrics.hot_from_hourly,
    "channel_pvuv": metrics.pvuv_from_hourly,
    "channel_freshness": metrics.freshness_from_hourly,
}

_SUMS = ", ".join(f"{name} bigint" for name in metrics.HOURLY_SUMS)
BASE_SCHEMA = f"channelId string, hourKey bigint, {_SUMS}"
DELTA_SCHEMA = f"windowStart bigint, {BASE_SCHEMA}"
LAST_SCHEMA = "channelId string, windowStart bigint, visited bigint"


def add_totals(table: str, *parts: DataFrame) -> DataFrame:
    """Old totals and any number of deltas to new totals."""
    key, sums = TOTALS[table]
    every = parts[0].select(*key, *sums)
    for part in parts[1:]:
        every = every.unionByName(part.select(*key, *sums))
    return every.groupBy(*key).agg(*[F.sum(n).cast("bigint").alias(n) for n in sums])


# Windows of one key that are summed up in one go: some three and a half hours of them.
BLOCK_WINDOWS = 4096


def totals_by_window(table: str, windows: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The totals as each window's write leaves them: ``windows`` with running instead of own sums.

    A key's windows are cut into blocks of time, so a block has at most ``block_windows`` rows and a
    channel that holds most of the rows is spread like all others. The blocks are summed first, with
    partial sums where the windows are read; what came before a block then goes along as its first
    row, so the windows themselves pass one exchange. Give it windows that are stored: they are
    read twice.
    """
    key, sums = TOTALS[table]
    block = F.floor(F.col("windowStart") / (metrics.WINDOW_MS * block_windows))
    cut = windows.select("windowStart", *key, *sums).withColumn("_block", block)
    earlier = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = cut.groupBy(*key, "_block").agg(*[F.sum(n).alias(n) for n in sums]) \
        .withColumns({n: F.coalesce(F.sum(n).over(earlier), F.lit(0)) for n in sums})
    so_far = Window.partitionBy(*key, "_block").orderBy(F.col("windowStart").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        cut.unionByName(before, allowMissingColumns=True)
        .withColumns({n: F.sum(n).over(so_far).cast("bigint") for n in sums})
        .where("windowStart IS NOT NULL").drop("_block")
    )


class Ledger:
    """The stream's sums below a folder, and every result table read from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self.log = BatchLog(spark, f"{self.folder}/sums", DELTA_SCHEMA)

    def append(self, windows: DataFrame, batch_id: int) -> None:
        """Writes a batch's sums; adaptive execution sizes the files."""
        rows = windows.select("windowStart", "channelId", "hourKey", *metrics.HOURLY_SUMS)
        self.log.append(rows.hint("rebalance"), batch_id)

    def windows(self, table: str, **options) -> DataFrame:
        """A result table per window, of all batches, folded ones too."""
        done = self.log.folded_up_to()
        return FROM_HOURLY[table](self._windows(done, self.log.batches(done)), "windowStart", **options)

    def _windows(self, done: int, fresh: DataFrame) -> DataFrame:
        every = self.log.base("windows", done, DELTA_SCHEMA).unionByName(fresh.drop("batch_id"))
        return every.groupBy("windowStart", "channelId", "hourKey").agg(
            *[F.sum(n).cast("bigint").alias(n) for n in metrics.HOURLY_SUMS])

    def totals(self, table: str, **options) -> DataFrame:
        """The current totals of a result table."""
        done = self.log.folded_up_to()
        fresh = self.log.batches(done).drop("windowStart", "batch_id")
        every = self.log.base("base", done, BASE_SCHEMA).unionByName(fresh)
        return FROM_HOURLY[table](every, **options)

    def totals_by_window(self, table: str, **options) -> DataFrame:
        """The totals of a result table as each window's write left them."""
        return totals_by_window(table, keep_table(self.windows(table, **options), "ledger-windows"))

    def last_windows(self) -> DataFrame:
        """Per channel the count of its latest window only, not the running total."""
        done = self.log.folded_up_to()
        return self._last(done, self.log.batches(done)).drop("windowStart")

    def _last(self, done: int, fresh: DataFrame) -> DataFrame:
        every = self.log.base("last", done, LAST_SCHEMA).unionByName(
            fresh.select(*[n.split()[0] for n in LAST_SCHEMA.split(", ")]))
        summed = metrics.hot_from_hourly(every, "windowStart")
        return summed.groupBy("channelId").agg(
            F.max("windowStart").alias("windowStart"),
            F.max_by("visited", "windowStart").alias("visited"))

    def fold(self, upto: int) -> None:
        """Sums the batches up to and including ``upto`` into a new base."""
        def parts(done: int, fresh: DataFrame) -> dict[str, DataFrame]:
            every = self.log.base("base", done, BASE_SCHEMA).unionByName(
                fresh.drop("windowStart", "batch_id"))
            summed = every.groupBy("channelId", "hourKey").agg(
                *[F.sum(n).cast("bigint").alias(n) for n in metrics.HOURLY_SUMS])
            return {"base": summed, "last": self._last(done, fresh),
                    "windows": self._windows(done, fresh)}

        self.log.fold(upto, parts)

    def maintain(self, batch_id: int, every: int) -> None:
        self.log.maintain(batch_id, every, self.fold)
