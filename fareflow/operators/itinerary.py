"""Nested itineraries to flat rows, with higher-order functions and no shuffle."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fareflow import functions as X
from fareflow.functions.numbers import as_type


def stops_label(legs: Column) -> Column:
    return F.when(legs == 1, "zero").when(legs == 2, "one").otherwise("two_or_more")


def flatten_options(
    options: DataFrame, option: str = "option", seat_class: str = "class"
) -> DataFrame:
    """One event per option with at least one leg.

    ``options`` holds the option struct beside source_city, destination_city, travel_date
    (text), the class column and observed_at (timestamp).
    """
    legs = F.col(f"{option}.flights")
    first, last = F.try_element_at(legs, F.lit(1)), F.try_element_at(legs, F.lit(-1))
    minutes = F.aggregate(
        legs, F.lit(0), lambda total, leg: total + F.coalesce(leg["duration"], F.lit(0))
    )
    observed = F.col("observed_at")
    shaped = options.filter(F.size(legs) > 0).select(
        F.date_format(observed, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("observed_at"),
        "source_city",
        "destination_city",
        "travel_date",
        F.try_element_at(F.col(f"{option}.airlines"), F.lit(1)).alias("airline"),
        F.col(f"{option}.type").alias("airline_code"),
        X.clock_label(first["departure"]).alias("departure_time"),
        X.clock_label(last["arrival"]).alias("arrival_time"),
        stops_label(F.size(legs)).alias("stops"),
        minutes.alias("duration"),
        F.col(seat_class).alias("class"),
        F.col(f"{option}.price").alias("price"),
        F.lit("INR").alias("currency"),
        X.days_until(
            X.travel_date(F.col("travel_date")), F.to_date(observed), clamp=False
        ).alias("days_left"),
    )
    return shaped.select(X.business_id(shaped.columns).alias("event_id"), "*")


def flatten_legs(
    legs: DataFrame, option_keys: list[str], order: list[str]
) -> DataFrame:
    """The same flattening for legs stored one per row.

    Every measure has a map-side partial, so no group of legs is ever gathered. ``legs``
    has airline, departure and arrival (``HH:MM``) and duration columns.
    """
    position = F.struct(*order)
    return legs.groupBy(*option_keys).agg(
        F.min_by("airline", position).alias("airline"),
        F.min_by("departure", position).alias("departure_time"),
        F.max_by("arrival", position).alias("arrival_time"),
        stops_label(F.count(F.lit(1))).alias("stops"),
        F.sum("duration").alias("duration"),
    )


def _legs_minutes(legs: Column, kind: T.DataType) -> Column:
    def minutes(leg: Column) -> Column:
        value = leg["duration"]
        text = X.duration_text_minutes(as_type(value, kind, "string"))
        number = as_type(value, kind, "double").cast("bigint")
        return F.coalesce(F.when(X.is_text(value, kind), text).otherwise(number), F.lit(0))

    zero = F.lit(0).cast("bigint")
    return F.aggregate(legs, zero, lambda total, leg: total + minutes(leg))


def total_minutes(option: Column, kind: T.StructType) -> Column:
    """A text total is read as text, a non-zero number is taken, else the legs are added."""
    total, total_kind = option["total_duration"], kind["total_duration"].dataType
    leg_kind = kind["flights"].dataType.elementType["duration"].dataType
    number = as_type(total, total_kind, "double").cast("bigint")
    text = X.duration_text_minutes(as_type(total, total_kind, "string"))
    return (
        F.when(X.is_text(total, total_kind), text)
        .when(number != 0, number)
        .otherwise(_legs_minutes(option["flights"], leg_kind))
    )


def flatten_responses(responses: DataFrame, *keep: str) -> DataFrame:
    """Search responses to flat quotes: the best options, then the others.

    Options without legs are left out; an option without a usable price stays, with NULL.
    """
    kind = responses.schema["best_flights"].dataType.elementType
    empty = F.array().cast(responses.schema["best_flights"].dataType)
    lists = [F.coalesce(F.col(c), empty) for c in ("best_flights", "other_flights")]
    exploded = responses.select(*keep, F.explode(F.concat(*lists)).alias("o"))
    option, legs = F.col("o"), F.col("o.flights")
    first, last = F.try_element_at(legs, F.lit(1)), F.try_element_at(legs, F.lit(-1))
    prices = [
        X.usable_price(option[name], kind[name].dataType)
        for name in ("price", "extracted_price", "total_price")
    ]
    return exploded.filter(F.size(legs) > 0).select(
        *keep,
        F.coalesce(first["airline"], F.lit("Unknown")).alias("airline"),
        X.clock_text(first["departure_airport"]["time"]).alias("departure_time"),
        X.clock_text(last["arrival_airport"]["time"]).alias("arrival_time"),
        total_minutes(option, kind).alias("duration_minutes"),
        F.greatest(F.size(legs) - 1, F.lit(0)).alias("stops"),
        F.coalesce(*prices).alias("live_price"),
        F.lit("INR").alias("currency"),
    )
