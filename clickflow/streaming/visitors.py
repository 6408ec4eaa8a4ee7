"""New-visitor flags on a stream, from state kept per user and channel.

The state is the visitor's last click and never expires, since a visitor counts as new only
once. It comes before any watermark, so clicks too late for a window still update it. Visitors
share slots by a hash of their name, and a slot's state holds the last clicks of all its
visitors: Python is called, and state is read and written, once per slot and micro-batch
instead of once per visitor. Python finds only the hour of the click before; Spark's
expressions turn it into flags, the same ones as for bounded tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from clickflow.operators.visitors import add_flags, can_be_known
from clickflow.operators.widen import with_hour_key

# The last clicks of a slot's visitors, side by side.
STATE = "visitors array<string>, lastVisitedTime array<bigint>, lastHour array<bigint>"

# Slots of visitors, for as long as the checkpoint lives. A batch rewrites the slots it touches,
# so more slots write less in small batches and call Python more often in large ones: with one to
# ten thousand visitors in a slot neither weighs much.
SLOTS = 1 << 12

# Stands for "no click before"; below every real hour number.
NONE_BEFORE = 0


def visitor_name() -> Column:
    """User and channel as one text, different for different pairs: the user's length leads.

    One key column instead of two is one column less for Python to take in and give back.
    Clicks that can never have a history have no name.
    """
    name = F.concat(F.length("userID").cast("string"), F.lit(":"), "userID", "channelID")
    return F.when(can_be_known(), name)


def visitor_slot(slots: int) -> Column:
    """A visitor's slot; clicks without a name are spread over all slots."""
    dealt = F.when(F.col("_visitor").isNull(), F.xxhash64("seq")).otherwise(F.xxhash64("_visitor"))
    return F.pmod(dealt, F.lit(slots)).cast("int")


def _whole(numbers: pd.Series) -> list[int | None]:
    """A column as Python's whole numbers; one with nulls arrives as floats."""
    if numbers.dtype.kind != "f":
        return numbers.tolist()
    return [None if n != n else int(n) for n in numbers.tolist()]


def previous_visits(key, frames: Iterator[pd.DataFrame],
                    state: GroupState) -> Iterator[pd.DataFrame]:
    """Adds the hour of the visitor's click before to one slot's clicks of a micro-batch."""
    parts = list(frames)
    rows = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    seq = rows["seq"].to_numpy()
    if (seq[1:] < seq[:-1]).any():
        rows = rows.iloc[np.argsort(seq, kind="stable")]
    last = {}
    if state.exists:
        visitors, *clicks = state.get
        last = dict(zip(visitors, zip(*clicks)))
    before = []
    for name, ms, hour in zip(rows["_visitor"].tolist(), _whole(rows["timestamp"]), _whole(rows["hourKey"])):
        before.append(last[name][1] or NONE_BEFORE if name in last else NONE_BEFORE)
        if name is not None:
            last[name] = (ms, hour)
    if last:
        state.update((list(last), *map(list, zip(*last.values()))))
    yield rows.assign(previousHour=np.array(before, "int64"))


def stream_visitor_flags(clicks: DataFrame, keep: list[str] | None = None,
                         slots: int = SLOTS) -> DataFrame:
    """Clicks of a stream with the four flags, the kept columns, ``timestamp`` and ``seq``.

    Name the columns to ``keep``: every one of them passes through Python. A checkpoint keeps
    the number of ``slots`` it began with.
    """
    wanted = list(keep if keep is not None else clicks.columns)
    wanted += [n for n in ("seq", "timestamp") if n not in wanted]
    keyed = with_hour_key(clicks).select(
        visitor_name().alias("_visitor"), "hourKey", *wanted).withColumn("_slot", visitor_slot(slots))
    output = StructType([*keyed.schema.fields, StructField("previousHour", LongType())])
    found = keyed.groupBy("_slot").applyInPandasWithState(
        previous_visits, output, STATE, "append", GroupStateTimeout.NoTimeout)
    previous = F.nullif("previousHour", F.lit(NONE_BEFORE))
    return add_flags(found.withColumn("previousHour", previous)).drop("_visitor", "_slot")


STATE_OPERATOR = "applyInPandasWithState"


def state_history(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The last visit per user and channel that a stream of flags remembers, read from its state.

    The state is that of the last batch the checkpoint has finished, or of an earlier one that it still
    keeps. Each state partition is read by a task of its own; the stream may run on meanwhile.
    """
    found = spark.read.format("state-metadata").load(checkpoint)
    operator = found.where(F.col("operatorName") == STATE_OPERATOR).select("operatorId").first()
    if operator is None:
        raise ValueError(f"no visitor state below {checkpoint}")
    reader = spark.read.format("statestore").option("operatorId", operator[0])
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    name = F.col("_last.visitors")
    length = F.split_part(name, F.lit(":"), F.lit(1))
    start = F.length(length) + 2
    user = F.substring(name, start, length.cast("int"))
    held = F.col("value.groupState")
    last = F.arrays_zip(*[held[n].alias(n) for n in ("visitors", "lastVisitedTime")])
    return reader.load(checkpoint).select(F.explode(last).alias("_last")).select(
        user.alias("userid"), F.substring(name, start + length.cast("int"), F.length(name)).alias("channelid"),
        F.col("_last.lastVisitedTime").alias("lastVisitedTime"))
