"""Row-wise columns of the widened click."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickflow.functions.calendar import day_text, hour_key, hour_text, month_text
from clickflow.functions.text import join_text
from clickflow.schemas import WIDE_COLUMNS


def with_hour_key(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("hourKey", hour_key("timestamp"))


def with_address(clicks: DataFrame) -> DataFrame:
    """Country, province and city with nothing between; a missing one reads ``null``."""
    return clicks.withColumn("address", join_text("country", "province", "city"))


def with_periods(clicks: DataFrame) -> DataFrame:
    """Month, day and hour texts of the click's own time."""
    keyed = clicks if "hourKey" in clicks.columns else with_hour_key(clicks)
    return keyed.withColumns({
        "yearMonth": month_text("hourKey"),
        "yearMonthDay": day_text("hourKey"),
        "yearMonthDayHour": hour_text("hourKey"),
    })


def wide_clicks(flagged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 22 columns of the widened click, from clicks that carry visitor flags."""
    return with_periods(with_address(flagged)).select(*keep, *WIDE_COLUMNS)
