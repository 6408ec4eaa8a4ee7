"""Splitting of groups too big for one task.

Finding a row's predecessor within its key needs the key's rows in order, and a window does
that in one task per key. A key that holds a large part of all rows is cut into *blocks* of
neighbouring sequence numbers, about equally many rows in each; the blocks go to different
tasks and only one row per block is needed to join them up again. Which keys are cut, and
where, changes the balance of the work, never the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Rows with no usable key need no ordering at all and are spread over this many groups.
KEYLESS_GROUPS = 4096


# Quantiles taken of a hot key's sequence numbers, kept in groups of so many.
LIMITS, GROUP = 1024, 32

# No key below this share of the rows can be listed, so the list has at most so many keys.
LEAST_SHARE = 1 / 65536


@dataclass(frozen=True)
class HotKeys:
    """Keys to cut, each with the rising sequence numbers at which its blocks begin."""

    names: tuple[str, ...]
    keys: tuple[tuple, ...]
    limits: tuple[tuple, ...]

    def mark(self, df: DataFrame, seq: str, flag: str, block: str) -> DataFrame:
        """Adds a true flag and a block number from 1 on rows of the listed keys, else null.

        A row's block is the number of limits up to its own sequence number, found in two
        steps, first among the groups and then inside one. The list is broadcast: it holds at
        most one key per ``hot_share`` of the rows and its limits, whatever the data size.
        """
        kind = df.schema[seq].dataType.simpleString()
        schema = ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in self.names)
        rows = [(*key, [list(own[k:k + GROUP]) for k in range(0, len(own), GROUP)])
                for key, own in zip(self.keys, self.limits)]
        listed = df.sparkSession.createDataFrame(rows, f"{schema}, _groups array<array<{kind}>>")
        joined = df.join(F.broadcast(listed.withColumn(flag, F.lit(True))), list(self.names), "left")
        at = F.col(seq)
        group = F.size(F.filter("_groups", lambda g: g[0] <= at))
        inside = F.size(F.filter(F.element_at("_groups", group), lambda limit: limit <= at))
        return joined.withColumn(block, F.when(F.col(flag), F.when(
            group > 0, (group - 1) * GROUP + inside + 1).otherwise(1)).cast("bigint")).drop("_groups")


def find_hot_keys(df: DataFrame, names: list[str], seq: str, usable: Column | None = None,
                  hot_share: float = 1 / 2048, fraction: float = 0.001,
                  least_rows: int = 16, limits: int = LIMITS) -> HotKeys | None:
    """Looks for keys that hold more than ``hot_share`` of the rows; None if there are none.

    One pass over a sample, which is kept while counts and then the hot keys' quantiles are
    taken from it. The sample only steers the balance; ``least_rows`` sampled rows are needed
    for a key to count. At most ``1 / hot_share`` keys are collected, each with limits in
    proportion to its rows, so that blocks of all keys are about alike.
    """
    if hot_share < LEAST_SHARE:
        raise ValueError(f"hot_share must be at least {LEAST_SHARE}: the list of keys is collected")
    narrow = df.where(usable) if usable is not None else df
    narrow = narrow.select(*names, seq)
    sample = (narrow if fraction >= 1 else narrow.sample(fraction, seed=7)).persist()
    try:
        total = sample.count()
        counted = sample.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows")).where(
            F.col("_rows") > F.lit(float(max(total * hot_share, least_rows))))
        steps = [k / limits for k in range(1, limits)]
        found = sample.join(F.broadcast(counted), names).groupBy(*names).agg(
            F.first("_rows").alias("_rows"), F.percentile_approx(seq, steps, 10000).alias("_limits")).collect()
    finally:
        sample.unpersist()
    if not found:
        return None
    most = max(row["_rows"] for row in found)
    own = [sorted(set(row["_limits"][::max(1, most // row["_rows"])])) for row in found]
    return HotKeys(tuple(names), tuple(tuple(row[n] for n in names) for row in found), tuple(map(tuple, own)))
