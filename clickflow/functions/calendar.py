"""Calendar periods of epoch-millisecond times, in the session time zone.

An hour is held as the whole number ``yyyyMMddHH``. For the years 1 to 9999 such numbers
order exactly like the texts they stand for, need no text formatting per row, and give the
day and the month by whole-number division.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Epoch milliseconds of 0001-01-01 and of the last millisecond of 9999, with a day left on
# either side for the time zone.
FIRST_MS = -62135510400000
LAST_MS = 253402214399999


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def period_text(ms, pattern: str) -> Column:
    """Epoch milliseconds as text by a date pattern."""
    return F.date_format(F.timestamp_millis(_col(ms)), pattern)


def compare_date(current_ms, history_ms, pattern: str) -> Column:
    """1 where the current time's text is greater than the historic one's, else 0."""
    later = period_text(current_ms, pattern) > period_text(history_ms, pattern)
    return F.when(later, 1).otherwise(0).cast("int")


def hour_key(ms: str) -> Column:
    """A column of epoch milliseconds as the whole number yyyyMMddHH."""
    at = f"timestamp_millis({ms})"
    day = f"date({at})"
    return F.expr(
        f"year({day}) * 1000000L + month({day}) * 10000 + day({day}) * 100 + hour({at})")


def hour_text(key) -> Column:
    return F.lpad(_col(key).cast("string"), 10, "0")


def day_text(key) -> Column:
    return F.left(hour_text(key), F.lit(8))


def month_text(key) -> Column:
    return F.left(hour_text(key), F.lit(6))


def event_time(payload_ms, arrival_ms) -> Column:
    """The later of the payload's time and the broker's; a missing broker time is passed over."""
    return F.greatest(_col(payload_ms), _col(arrival_ms))
