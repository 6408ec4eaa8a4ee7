from clickflow.functions.calendar import (
    compare_date, day_text, event_time, hour_key, hour_text, month_text, period_text,
)
from clickflow.functions.text import (
    is_blank, is_not_blank, join_text, map_get_or, text_or_null_word, to_long, to_text,
)

__all__ = [
    "compare_date", "day_text", "event_time", "hour_key", "hour_text", "month_text",
    "period_text", "is_blank", "is_not_blank", "join_text", "map_get_or",
    "text_or_null_word", "to_long", "to_text",
]
