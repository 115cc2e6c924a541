"""Date, time and clock expressions. Unreadable input gives NULL, never an error."""

from pyspark.sql import Column, functions as F

from fareflow.constants import DATE_PATTERN, EVENT_TIME_PATTERN
from fareflow.functions.text import strip_all_space


def travel_date(col: Column, pattern: str = DATE_PATTERN) -> Column:
    return F.try_to_date(col, pattern)


def event_time(col: Column, pattern: str = EVENT_TIME_PATTERN) -> Column:
    """ISO event time; the fraction may be missing."""
    return F.try_to_timestamp(col, F.lit(pattern))


def days_until(travel: Column, observed: Column, clamp: bool = True) -> Column:
    days = F.datediff(travel, observed)
    return F.greatest(days, F.lit(0)) if clamp else days


def clock_text(col: Column) -> Column:
    """The last ``H:MM`` in the text, else the stripped text, else ``00:00`` for NULL."""
    found = F.regexp_extract_all(col, F.lit(r"\b\d{1,2}:\d{2}\b"), F.lit(0))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), strip_all_space(col), F.lit("00:00"))


def clock_label(parts: Column) -> Column:
    """``HH:MM`` from an ``[hour, minute]`` array with missing parts as 0."""
    hour = F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(0))
    minute = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(0))
    return F.format_string("%02d:%02d", hour, minute)


def day_part(clock: Column) -> Column:
    """Day-part label of ``HH:MM``, so live quotes share the labels of the history.

    The four-hour boundaries are our own choice.
    """
    hour = F.substring_index(clock, ":", 1).try_cast("int")
    return (
        F.when(hour.between(4, 7), "Early_Morning")
        .when(hour.between(8, 11), "Morning")
        .when(hour.between(12, 15), "Afternoon")
        .when(hour.between(16, 19), "Evening")
        .when(hour.between(20, 23), "Night")
        .when(hour.between(0, 3), "Late_Night")
    )
