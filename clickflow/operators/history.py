"""The visitor history as a bucketed table on disk, for flagging batches one after another.

Each batch adds the last visit of the visitors it saw. Older rows of the same visitor stay
until their bucket is folded; a lookup takes the newest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickflow.functions.calendar import hour_key
from clickflow.operators.buckets import BATCHES, BucketTable
from clickflow.operators.skew import KEYLESS_GROUPS, HotKeys
from clickflow.operators.visitors import add_flags, can_be_known, user_history, with_previous_hour

SCHEMA = "userid string, channelid string, lastVisitedTime bigint"
KEY = ["userid", "channelid"]

# A join on slot, user and channel may use a layout by slot alone.
JOIN_SETTINGS = {"spark__sql__requireAllClusterKeysForCoPartition": "false"}


class VisitorHistory:
    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.table = BucketTable(spark, f"{folder.rstrip('/')}/history", SCHEMA, KEY, buckets)

    def known(self, visitors: DataFrame, batch_id: int) -> DataFrame:
        """What earlier batches left on the slots of some visitors (``userID``, ``channelID``)."""
        slots = self.table.touched(visitors, "userID", "channelID")
        return self._newest(self.table.rows(slots, before=batch_id))

    def flag(self, clicks: DataFrame, batch_id: int, hot: HotKeys | None = None) -> DataFrame:
        """A batch's clicks with their flags, given all batches before it.

        The click before is found within the batch. Only a visitor's first click of the batch asks the
        history, of which just the buckets those visitors are in are read, where they are. All
        other clicks get slots of their own that no visitor has, so a busy visitor's are spread. Plan
        the result under ``JOIN_SETTINGS`` to spare the history's rows an exchange.
        """
        within = with_previous_hour(clicks, hot)
        known = self.known(clicks.where(can_be_known()), batch_id).select(
            F.col("slot").alias("_slot"), F.col("userid").alias("_user"), F.col("channelid").alias("_channel"),
            hour_key("lastVisitedTime").alias("_past"))
        alone = -1 - F.pmod(F.xxhash64("seq"), F.lit(KEYLESS_GROUPS))
        slot = F.when(can_be_known() & F.col("previousHour").isNull(), self.table.slot("userID", "channelID"))
        asking = within.withColumn("_ask", F.coalesce(slot, alone.cast("int")))
        found = asking.join(known, (F.col("_ask") == F.col("_slot")) & (F.col("userID") == F.col("_user"))
                            & (F.col("channelID") == F.col("_channel")), "left")
        previous = F.coalesce("previousHour", "_past")
        return add_flags(found.withColumn("previousHour", previous).drop(
            "_ask", "_slot", "_user", "_channel", "_past"))

    def append(self, clicks: DataFrame, batch_id: int) -> None:
        self.table.append(user_history(clicks), batch_id)

    def snapshot(self) -> DataFrame:
        """The last visit per user and channel."""
        return self._newest(self.table.rows()).drop("slot", "shard")

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("slot", "shard", "userid", "channelid").agg(
            F.max_by("lastVisitedTime", "batch_id").alias("lastVisitedTime"))

    def fold(self, upto: int, most: int = 1) -> list[int]:
        """Keeps only the newest row per visitor in buckets of more than ``most`` batches up to ``upto``."""
        return self.table.fold(upto, self._newest, most)

    def maintain(self, batch_id: int, every: int) -> None:
        """At every so many batches, folds the buckets that have got many."""
        if batch_id and batch_id % every == 0:
            self.fold(batch_id - 1, BATCHES)
