"""Numeric expressions: durations, prices, differences."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fareflow.constants import SIGNAL_THRESHOLD


def rounded_minutes(hours: Column) -> Column:
    """Hours to whole minutes, half up."""
    return F.round(hours * 60).cast("int")


def exact_minutes(hours: Column) -> Column:
    """Hours (number or text) to minutes without rounding; bad text gives NULL."""
    return hours.try_cast("double") * 60


def nan_to_null(col: Column) -> Column:
    """NaN, as a missing number comes from other tools, as NULL."""
    return F.when(~F.isnan(col), col)


def known_number(df: DataFrame, name: str) -> Column:
    """A column for statistics: of a float or double column NaN is NULL."""
    col = F.col(f"`{name}`")
    return nan_to_null(col) if isinstance(df.schema[name].dataType, T.FractionalType) and not isinstance(
        df.schema[name].dataType, T.DecimalType
    ) else col


def positive_or_null(col: Column) -> Column:
    return F.when(col > 0, col)


def price_number(col: Column) -> Column:
    """A numeric price, or NULL when it is not above zero."""
    return positive_or_null(col.cast("double"))


def price_text(col: Column) -> Column:
    """A price written as text. Everything but digits and points goes, a minus sign too."""
    return positive_or_null(F.regexp_replace(col, "[^0-9.]", "").try_cast("double"))


def is_text(col: Column, kind: T.DataType) -> Column:
    """Whether the value is text, for string, numeric and VARIANT columns."""
    if isinstance(kind, T.VariantType):
        return F.coalesce(F.schema_of_variant(col) == "STRING", F.lit(False))
    return col.isNotNull() if isinstance(kind, T.StringType) else F.lit(False)


def as_type(col: Column, kind: T.DataType, target: str) -> Column:
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(col, "$", target)
    return col.try_cast(target)


def usable_price(col: Column, kind: T.DataType) -> Column:
    """Price from a number or a text, by what the value is."""
    number = price_number(as_type(col, kind, "double"))
    return F.when(is_text(col, kind), price_text(as_type(col, kind, "string"))).otherwise(number)


def duration_text_minutes(col: Column) -> Column:
    """Minutes of ``2 hr 10 min`` or ``45 min``; 0 when there is nothing to read.

    Digits before the first ``h`` are the hours and are joined, so ``1.5h`` reads as 15
    hours; an ``h`` without digits makes the whole value 0.
    """
    text = F.lower(col)
    by_hour = F.split(text, "h")
    has_hours = F.contains(text, F.lit("h"))
    hours = _digits(F.try_element_at(by_hour, F.lit(1)))
    after_hours = F.when(has_hours, F.try_element_at(by_hour, F.lit(2))).otherwise(text)
    minutes = F.coalesce(_digits(F.substring_index(after_hours, "m", 1)), F.lit(0))
    minutes = F.when(F.contains(text, F.lit("m")), minutes).otherwise(F.lit(0))
    total = F.when(has_hours, F.coalesce(hours * 60 + minutes, F.lit(0))).otherwise(minutes)
    return F.coalesce(total, F.lit(0)).cast("bigint")


def _digits(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "").try_cast("bigint")


def difference_percent(actual: Column, expected: Column) -> Column:
    """Deviation from ``expected`` in percent, NULL when it is 0."""
    return F.try_divide(actual - expected, expected) * 100


def price_signal(difference: Column, threshold: float = SIGNAL_THRESHOLD) -> Column:
    """``higher``, ``below`` or ``stable``; exactly the threshold is stable."""
    return (
        F.when(difference > threshold, F.lit("higher"))
        .when(difference < -threshold, F.lit("below"))
        .when(difference.isNotNull(), F.lit("stable"))
    )
