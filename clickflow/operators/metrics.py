"""Channel metrics: heat, page views and unique visitors, freshness of visitors.

All measures are sums over clicks keyed by channel and period, and hours nest in days and
months. So clicks are summed once per channel and hour, and only those few sums are spread
over the coarser periods. The sums are partial on the map side, which keeps a channel that
holds most of the clicks from overloading a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

GRAINS = ("hour", "day", "month")
WINDOW_MS = 3000

# Sums of one channel and hour, enough for every metric below.
HOURLY_SUMS = ["visited", "newCount",
               "hourUv", "dayUv", "monthUv", "hourOld", "dayOld", "monthOld"]


# Period texts from the hour number.
PERIODS = {
    "hour": "lpad(CAST(hourKey AS STRING), 10, '0')",
    "day": "left(lpad(CAST(hourKey AS STRING), 10, '0'), 8)",
    "month": "left(lpad(CAST(hourKey AS STRING), 10, '0'), 6)",
}
GRAIN_FLAGS = {"hour": "isHourNew", "day": "isDayNew", "month": "isMonthNew"}


def is_old(grain_flag: str) -> str:
    """1 for a returning visitor's first click in a period, else 0."""
    return f"IF(isNew = 0 AND {grain_flag} = 1, 1, 0)"


def window_start(ms: str = "timestamp", window_ms: int = WINDOW_MS) -> Column:
    """Start of the tumbling window an epoch-millisecond time falls in."""
    at = F.col(ms)
    return (at - F.pmod(at, F.lit(window_ms))).cast("bigint")


def fan_out(rows: DataFrame, period: str, measures: dict[str, dict[str, str]],
            keep: tuple[str, ...], grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """One row per wanted period; ``measures`` gives each output column's value by grain."""
    unknown = set(grains) - set(GRAINS)
    if unknown or not grains:
        raise ValueError(f"grains must be some of {GRAINS}")
    values = [
        ", ".join([PERIODS[grain], *[f"CAST({m[grain]} AS BIGINT)" for m in measures.values()]])
        for grain in grains
    ]
    names = ", ".join(f"`{n}`" for n in [period, *measures])
    return rows.selectExpr(*keep, f"stack({len(grains)}, {', '.join(values)}) AS ({names})")


def hot_projection(clicks: DataFrame) -> DataFrame:
    """One row per click: its channel and count."""
    return clicks.select(F.col("channelID").alias("channelId"), F.col("count").alias("visited"))


def pvuv_fan_out(flagged: DataFrame, grains: tuple[str, ...] = GRAINS,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Per click one row for its hour, day and month: views, and the flag as a new visitor."""
    measures = {"pv": {g: "count" for g in GRAINS}, "uv": GRAIN_FLAGS}
    return fan_out(flagged, "yearMonthDayHour", measures, (*keep, "channelID AS channelId"), grains)


def freshness_fan_out(flagged: DataFrame, grains: tuple[str, ...] = GRAINS,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Per click one row for its hour, day and month: new and returning visitor counts."""
    measures = {"newCount": {g: "isNew" for g in GRAINS},
                "oldCount": {g: is_old(GRAIN_FLAGS[g]) for g in GRAINS}}
    return fan_out(flagged, "date", measures, (*keep, "channelID AS channelId"), grains)


def _sums(**sums: str) -> list[Column]:
    return [F.expr(f"CAST(sum({value}) AS BIGINT) AS {name}") for name, value in sums.items()]


def hourly_sums(flagged: DataFrame, *more_keys) -> DataFrame:
    """All sums per channel and hour (and further keys, such as a window)."""
    return flagged.groupBy(
        *more_keys, F.col("channelID").alias("channelId"), "hourKey",
    ).agg(*_sums(
        visited="count", newCount="isNew",
        hourUv="isHourNew", dayUv="isDayNew", monthUv="isMonthNew",
        hourOld=is_old("isHourNew"), dayOld=is_old("isDayNew"), monthOld=is_old("isMonthNew"),
    ))


def hot_from_hourly(hourly: DataFrame, *more_keys: str) -> DataFrame:
    return hourly.groupBy(*more_keys, "channelId").agg(*_sums(visited="visited"))


def pvuv_by_period(hourly: DataFrame, keep: tuple[str, ...],
                   grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """Hourly sums once for each wanted period."""
    measures = {"pv": {g: "visited" for g in GRAINS}, "uv": {g: f"{g}Uv" for g in GRAINS}}
    return fan_out(hourly, "yearMonthDayHour", measures, keep, grains)


def pvuv_from_hourly(hourly: DataFrame, *more_keys: str,
                     grains: tuple[str, ...] = GRAINS) -> DataFrame:
    key = (*more_keys, "channelId")
    spread = pvuv_by_period(hourly, key, grains)
    return spread.groupBy(*key, "yearMonthDayHour").agg(*_sums(pv="pv", uv="uv"))


def freshness_from_hourly(hourly: DataFrame, *more_keys: str,
                          grains: tuple[str, ...] = GRAINS) -> DataFrame:
    measures = {"newCount": {g: "newCount" for g in GRAINS},
                "oldCount": {g: f"{g}Old" for g in GRAINS}}
    key = (*more_keys, "channelId")
    spread = fan_out(hourly, "date", measures, key, grains)
    return spread.groupBy(*key, "date").agg(*_sums(newCount="newCount", oldCount="oldCount"))


def channel_pvuv(flagged: DataFrame, grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """Views and unique visitors per channel and period; all periods share one table."""
    return pvuv_from_hourly(hourly_sums(flagged), grains=grains)


def channel_freshness(flagged: DataFrame, grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """New and returning visitors per channel and period; all-zero rows are kept."""
    return freshness_from_hourly(hourly_sums(flagged), grains=grains)


def channel_hot(clicks: DataFrame) -> DataFrame:
    """Total click count per channel."""
    return hot_projection(clicks).groupBy("channelId").agg(*_sums(visited="visited"))


def _with_window(clicks: DataFrame, ms: str) -> DataFrame:
    return clicks.withColumn("windowStart", window_start(ms))


def channel_pvuv_windows(flagged: DataFrame, ms: str = "timestamp",
                         grains: tuple[str, ...] = GRAINS) -> DataFrame:
    hourly = hourly_sums(_with_window(flagged, ms), "windowStart")
    return pvuv_from_hourly(hourly, "windowStart", grains=grains)


def channel_freshness_windows(flagged: DataFrame, ms: str = "timestamp",
                              grains: tuple[str, ...] = GRAINS) -> DataFrame:
    hourly = hourly_sums(_with_window(flagged, ms), "windowStart")
    return freshness_from_hourly(hourly, "windowStart", grains=grains)


def channel_hot_windows(clicks: DataFrame, ms: str = "timestamp") -> DataFrame:
    """Click count per channel and three-second window."""
    return (
        _with_window(clicks, ms)
        .groupBy("windowStart", F.col("channelID").alias("channelId"))
        .agg(*_sums(visited="count"))
    )


def last_window(hot_windows: DataFrame) -> DataFrame:
    """Per channel the count of its latest window only, not the running total."""
    return hot_windows.groupBy("channelId").agg(
        F.max_by("visited", "windowStart").alias("visited"))
