"""History: raw rows to the canonical table, and its summaries."""

from collections.abc import Mapping

from pyspark.sql import DataFrame

from fareflow.operators.summaries import (
    HISTORY_AVERAGES,
    fare_partials,
    finish_partials,
    merge_partials,
)
from fareflow.operators.standardize import training_rows
from fareflow.sinks.tables import overwrite_table

FLIGHT_KEYS = ("airline", "source_city", "destination_city", "cabin_class")
ROUTE_KEYS = ("source_city", "destination_city", "cabin_class")


def history_summaries(canonical: DataFrame) -> dict[str, DataFrame]:
    """Carrier and route summaries; the route one is rolled up from the carriers' partials."""
    return from_partials(flight_partials(canonical))


def flight_partials(canonical: DataFrame) -> DataFrame:
    return fare_partials(canonical, FLIGHT_KEYS, averages=HISTORY_AVERAGES)


def from_partials(partials: DataFrame) -> dict[str, DataFrame]:
    routes = merge_partials(partials, ROUTE_KEYS)
    return {
        "flight_fare_analytics": finish_partials(partials, FLIGHT_KEYS, averages=HISTORY_AVERAGES),
        "route_fare_analytics": finish_partials(routes, ROUTE_KEYS, averages=HISTORY_AVERAGES),
    }


def write_history_gold(
    canonical: DataFrame, folders: Mapping[str, str], fmt: str = "parquet"
) -> None:
    """Write both summaries and the training rows to the folders named in ``folders``.

    The small partials are kept while both summaries are written, so the rows are read once for
    them.
    """
    partials = flight_partials(canonical).persist()
    try:
        tables = {**from_partials(partials), "ml_training_data": training_rows(canonical)}
        for name, path in folders.items():
            overwrite_table(tables[name], path, fmt)
    finally:
        partials.unpersist()
