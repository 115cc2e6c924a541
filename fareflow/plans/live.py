"""Live events: payload rows to the clean table. The same code serves batch and stream."""

from pyspark.sql import DataFrame, functions as F

from fareflow import functions as X
from fareflow.constants import LIVE_STOPS
from fareflow.operators.standardize import stops_count
from fareflow.operators.validity import keep_valid, live_rules


def shape_live(payload: DataFrame) -> DataFrame:
    """Standardised columns, before any rule drops a row."""
    tidy = payload.withColumns(
        {
            **X.trimmed("source_city", "destination_city", "airline", "class"),
            "airline_code": F.upper(F.trim("airline_code")),
            "currency": F.upper(F.trim("currency")),
            "stops": F.lower(F.trim("stops")),
            "travel_date": X.travel_date(F.col("travel_date")),
            "event_timestamp": X.event_time(F.col("observed_at")),
        }
    )
    ends = F.col("source_city"), F.col("destination_city")
    return tidy.withColumns(
        {
            "route": X.route_key(*ends, upper=True),
            "stops_count": stops_count(F.col("stops"), LIVE_STOPS, -1),
        }
    )


def clean_live(payload: DataFrame) -> DataFrame:
    """Standardised rows that pass every rule; duplicates are still there."""
    return keep_valid(shape_live(payload), live_rules())
