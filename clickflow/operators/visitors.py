"""New-visitor flags per user and channel, over bounded tables.

A click is compared with the previous click of the same user on the same channel, in arrival
order and whatever the two clicks' own times are. With no previous click all four flags are 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickflow.functions.calendar import hour_key
from clickflow.functions.text import is_blank
from clickflow.operators.skew import KEYLESS_GROUPS, HotKeys, find_hot_keys
from clickflow.operators.widen import with_hour_key

VISITOR_KEY = ["userID", "channelID"]
FLAG_NAMES = ["isNew", "isHourNew", "isDayNew", "isMonthNew"]


def can_be_known() -> Column:
    """Only a non-blank user on a non-null channel is ever remembered."""
    return ~is_blank("userID") & F.col("channelID").isNotNull()


def add_flags(clicks: DataFrame) -> DataFrame:
    """Turns ``previousHour`` and ``hourKey``, both yyyyMMddHH numbers, into the four flags."""
    def flag(step: int) -> Column:
        current, previous = (f"{n} - {n} % {step}" for n in ("hourKey", "previousHour"))
        return F.expr(f"IF(previousHour IS NULL OR {current} > {previous}, 1, 0)")

    return clicks.withColumns({
        "isNew": F.expr("IF(previousHour IS NULL, 1, 0)"),
        "isHourNew": flag(1),
        "isDayNew": flag(100),
        "isMonthNew": flag(10000),
    }).drop("previousHour")


def hot_visitors(clicks: DataFrame, **limits) -> HotKeys | None:
    """User and channel pairs with so many clicks that one task should not hold them."""
    return find_hot_keys(clicks, VISITOR_KEY, "seq", can_be_known(), **limits)


def with_previous_hour(clicks: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Adds ``previousHour``, the hour number of the visitor's previous click, if any.

    One exchange on (user, channel, block). Ordinary keys are one block. Keys listed in
    ``hot`` are cut into many; the last click of each block is carried over to the next
    through a join that reuses the same exchange on the big side. Clicks that can never have
    a history are spread out, since they need no order.
    """
    keyed = clicks if "hourKey" in clicks.columns else with_hour_key(clicks)
    known = can_be_known()
    keyless = F.pmod(F.xxhash64("seq"), F.lit(KEYLESS_GROUPS)) + 1
    if hot:
        keyed = hot.mark(keyed, "seq", "_hot", "_cut")
        block = F.when(~known, keyless).when(F.col("_hot"), F.col("_cut")).otherwise(0)
    else:
        block = F.when(~known, keyless).otherwise(0)
    keyed = keyed.withColumn("_block", block.cast("bigint"))

    key = [*VISITOR_KEY, "_block"]
    previous = F.lag("hourKey").over(Window.partitionBy(*key).orderBy("seq"))
    ordered = keyed.withColumn("previousHour", F.when(known, previous))
    if not hot:
        return ordered.drop("_block")

    carried = F.lag("_last").over(Window.partitionBy(*VISITOR_KEY).orderBy("_block"))
    carry = (
        keyed.where(F.col("_hot") & known)
        .groupBy(*key).agg(F.max_by("hourKey", "seq").alias("_last"))
        .select(*key, carried.alias("_carried"))
    )
    return (
        ordered.join(carry, key, "left")
        .withColumn("previousHour", F.coalesce("previousHour", "_carried"))
        .drop("_block", "_hot", "_cut", "_carried")
    )


def visitor_flags(clicks: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Clicks with ``isNew``, ``isHourNew``, ``isDayNew`` and ``isMonthNew``.

    Needs ``userID``, ``channelID``, ``timestamp`` (epoch ms) and ``seq``, a whole number
    that is unique and rises in arrival order.
    """
    return add_flags(with_previous_hour(clicks, hot))


def user_history(clicks: DataFrame) -> DataFrame:
    """Last visit per user and channel: the time of the click that arrived last.

    Clicks without a user or a channel leave no trace; a blank user does.
    """
    return (
        clicks.where(F.col("userID").isNotNull() & F.col("channelID").isNotNull())
        .groupBy(*VISITOR_KEY).agg(F.max_by("timestamp", "seq").alias("lastVisitedTime"))
        .select(F.col("userID").alias("userid"), F.col("channelID").alias("channelid"),
                "lastVisitedTime")
    )


# History rows are numbered from here up by batch, below every click's own number.
PAST_SEQ = -(1 << 63)


def flags_with_history(clicks: DataFrame, history: DataFrame,
                       hot: HotKeys | None = None) -> DataFrame:
    """Flags for one batch of clicks, given the history left by earlier batches.

    Each history row joins its visitor's clicks as a row before the first, so the lookup
    costs no exchange of its own beyond shuffling the history rows. A visitor may have a
    history row per earlier batch, told apart by ``batch_id``; the newest counts.
    """
    keyed = clicks if "hourKey" in clicks.columns else with_hour_key(clicks)
    batch = F.col("batch_id") + 1 if "batch_id" in history.columns else F.lit(0)
    earlier = history.select(
        F.col("userid").alias("userID"), F.col("channelid").alias("channelID"),
        (F.lit(PAST_SEQ) + batch).cast("bigint").alias("seq"),
        hour_key("lastVisitedTime").alias("hourKey"), F.lit(True).alias("_past"))
    both = keyed.withColumn("_past", F.lit(False)).unionByName(earlier, allowMissingColumns=True)
    return visitor_flags(both, hot).where(~F.col("_past")).drop("_past")


def update_history(history: DataFrame, clicks: DataFrame) -> DataFrame:
    """The history after a batch: its last click per visitor, else what was there before."""
    fresh = user_history(clicks).withColumn("_batch", F.lit(1))
    return (
        fresh.unionByName(history.withColumn("_batch", F.lit(0)))
        .groupBy("userid", "channelid")
        .agg(F.max_by("lastVisitedTime", "_batch").alias("lastVisitedTime"))
    )
