"""Lookups, route pairs and search requests."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from fareflow.constants import SEAT_NAMES

def attach(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str], strict: bool = False
) -> DataFrame:
    """Left join of a keyed dimension: ``on`` maps columns of ``df`` to those of ``dim``.

    There is no broadcast hint: Spark knows the size of stored tables and, under adaptive
    execution, of shuffled ones, and broadcasts below its own byte limit.

    With ``strict`` a row without its match is an error, as a missing dictionary key is.
    """
    renamed = dim.withColumnsRenamed({right: left for left, right in on.items()})
    values = [c for c in renamed.columns if c not in on]
    joined = df.join(renamed.withColumn("_hit", F.lit(True)), list(on), "left")
    if strict:
        shown = F.concat_ws(", ", *[F.col(c).cast("string") for c in on])
        miss = F.raise_error(F.concat(F.lit("no match for "), shown))
        checked = {c: F.when(F.col("_hit"), F.col(c)).otherwise(miss) for c in values}
        joined = joined.withColumns(checked)
    return joined.drop("_hit")


def observed_routes(df: DataFrame, start: str, end: str) -> DataFrame:
    """Ordered pairs of distinct cities that occur, for example to offer as destinations."""
    return df.filter(F.col(start) != F.col(end)).select(start, end).distinct()


def city_pairs(df: DataFrame, city: str, other: str) -> DataFrame:
    """Every ordered pair of different cities that occur in ``city``.

    The distinct cities are gathered in one array; there are as many as places served.
    """
    cities = df.select(city).filter(F.col(city).isNotNull()).distinct()
    everywhere = cities.agg(F.array_sort(F.collect_set(city)).alias("_all"))
    pairs = everywhere.select(F.explode("_all").alias(city), "_all")
    return pairs.select(city, F.explode("_all").alias(other)).filter(F.col(city) != F.col(other))


def search_requests(routes: DataFrame, seats: Mapping[str, str] = SEAT_NAMES) -> DataFrame:
    """Each route with each cabin class and its seat name, one search request per row."""
    classes = F.array(
        *[F.struct(F.lit(c).alias("class"), F.lit(s).alias("seat")) for c, s in seats.items()]
    )
    return routes.withColumn("_class", F.explode(classes)).select(
        *routes.columns, "_class.class", "_class.seat"
    )
