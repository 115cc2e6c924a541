"""Column expressions: Column in, Column out."""

from fareflow.functions.numbers import (
    difference_percent,
    duration_text_minutes,
    exact_minutes,
    is_text,
    known_number,
    nan_to_null,
    positive_or_null,
    price_number,
    price_text,
    price_signal,
    rounded_minutes,
    usable_price,
)
from fareflow.functions.text import (
    business_id,
    free_text_key,
    random_id,
    recode,
    route_key,
    strip_all_space,
    trimmed,
)
from fareflow.functions.times import (
    clock_label,
    clock_text,
    day_part,
    days_until,
    event_time,
    travel_date,
)

__all__ = [
    "business_id",
    "clock_label",
    "clock_text",
    "day_part",
    "days_until",
    "difference_percent",
    "duration_text_minutes",
    "event_time",
    "exact_minutes",
    "free_text_key",
    "is_text",
    "known_number",
    "nan_to_null",
    "positive_or_null",
    "price_number",
    "price_signal",
    "price_text",
    "random_id",
    "recode",
    "rounded_minutes",
    "route_key",
    "strip_all_space",
    "travel_date",
    "trimmed",
    "usable_price",
]
