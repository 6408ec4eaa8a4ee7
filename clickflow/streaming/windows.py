"""Event time, watermark and tumbling windows of a click stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickflow.functions.calendar import event_time
from clickflow.operators import metrics

WINDOW = "3 seconds"
LATENESS = "2 seconds"
LATENESS_MS = 2000


def event_ms(clicks: DataFrame) -> Column:
    """The click's own time, or the broker's if that is later."""
    if "arrivalMs" in clicks.columns:
        return event_time("timestamp", "arrivalMs")
    return F.col("timestamp")


def with_watermark(clicks: DataFrame) -> DataFrame:
    return (
        clicks.withColumn("eventTime", F.timestamp_millis(event_ms(clicks)))
        .withWatermark("eventTime", LATENESS)
    )


def window_sums(flagged: DataFrame) -> DataFrame:
    """All metric sums per window, channel and hour, emitted once when the window is over.

    One aggregation serves every metric; days and months are rolled up after it, which keeps
    the state a third of what separate periods would need.
    """
    sums = metrics.hourly_sums(with_watermark(flagged), F.window("eventTime", WINDOW))
    return sums.select(
        F.unix_millis("window.start").alias("windowStart"), "channelId", "hourKey",
        *metrics.HOURLY_SUMS)


# What a period is cut to, by the length of its text.
PERIOD_UNITS = {10: "HOUR", 8: "DAY", 6: "MONTH"}
LEFT_OUT_MS = 1  # at the end of a period, so that it does not touch the next one


def _rest_of_period(at: str, period: str) -> Column:
    """How long the period a time is in still lasts, as text of an interval."""
    whens = " ".join(f"WHEN {length} THEN date_trunc('{unit}', {at}) + INTERVAL 1 {unit}"
                     for length, unit in PERIOD_UNITS.items())
    end = F.expr(f"unix_millis(CASE length({period}) {whens} END)")
    left = end - F.unix_millis(F.col(at)) - LEFT_OUT_MS
    return F.concat(F.greatest(left, F.lit(1)).cast("string"), F.lit(" milliseconds"))


def pvuv_rollup(flagged: DataFrame, grains: tuple[str, ...] = metrics.GRAINS) -> DataFrame:
    """Views and unique visitors per channel and period, each emitted once when its period is over.

    A second stateful aggregation over the sums of windows: every window's sums open, for each of their
    periods, a session that lasts until the period ends in the session's time zone, so the windows of an hour,
    day or month, which has no fixed length, are one session. The state holds open windows and one row
    per channel and open period. A click whose broker time falls into a later period than its own keeps
    its own period's name and comes in a row of its own.
    """
    windows = metrics.hourly_sums(with_watermark(flagged), F.window("eventTime", WINDOW)) \
        .withColumn("at", F.window_time("window"))
    spread = metrics.pvuv_by_period(windows, ("at", "channelId"), grains)
    session = F.session_window("at", _rest_of_period("at", "yearMonthDayHour"))
    return spread.groupBy(session.alias("session"), "channelId", "yearMonthDayHour").agg(
        F.sum("pv").alias("pv"), F.sum("uv").alias("uv")).drop("session")
