"""Live summary tables, recomputed in one go or kept up to date batch by batch.

The recomputation reads the clean table once for the finest partials and derives the rest
from them. The incremental form keeps partials per month. A batch is merged with the partials of
the months it touches, and only those of the summary tables are written again, so a refresh
costs what the batch and its months cost, however long the history is.
"""

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareflow.constants import WINDOW_SIZE_SECONDS
from fareflow.operators.summaries import fare_partials, finish_partials, merge_partials
from fareflow.operators.windows import slide_bucket, window_partials
from fareflow.sinks.generations import read_generation, write_generation
from fareflow.sinks.tables import overwrite_partitions, overwrite_table
from fareflow.sources.tables import query_over, read_table
from fareflow.workspace import remove

ROUTE_KEYS = ("route", "travel_date", "class")
CARRIER_KEYS = ("route", "travel_date", "airline", "airline_code", "class")
WINDOW_KEYS = ("route", "class")
WINDOW_COLUMNS = ("window_start", "window_end", *WINDOW_KEYS)


def summary_sql(keys: Sequence[str], price: str = "price", count: str = "flight_count") -> str:
    """The price summary per key as SQL text over a frame named ``rows``."""
    measures = {
        count: "count(*)",
        "avg_price": f"round(avg({price}), 2)",
        "min_price": f"min({price})",
        "max_price": f"max({price})",
    }
    columns = [*keys, *[f"{sql} AS {name}" for name, sql in measures.items()]]
    return f"SELECT {', '.join(columns)} FROM {{rows}} GROUP BY {', '.join(keys)}"


def route_prices_sql(clean: DataFrame) -> DataFrame:
    return query_over(summary_sql(ROUTE_KEYS), rows=clean)


def finest_partials(clean: DataFrame) -> DataFrame:
    """Partials per carrier, travel date and ten-minute bucket of event time."""
    return fare_partials(clean, [*CARRIER_KEYS, slide_bucket("event_timestamp").alias("bucket_start")])


def gold_tables(partials: DataFrame) -> dict[str, DataFrame]:
    """The three summary tables from the finest partials."""
    windows = window_partials(partials, WINDOW_KEYS)
    return {
        "route_price_analytics": finish_partials(merge_partials(partials, ROUTE_KEYS), ROUTE_KEYS),
        "airline_price_analytics": finish_partials(
            merge_partials(partials, CARRIER_KEYS), CARRIER_KEYS
        ),
        "price_window_analytics": finish_partials(
            windows, WINDOW_COLUMNS, count="price_observations"
        ),
    }


#: Time by which each summary table is partitioned, and the span of a partition.
TIMES = {
    "route_price_analytics": "travel_date",
    "airline_price_analytics": "travel_date",
    "price_window_analytics": "window_start",
}
GRAIN = "month"


def part_of(time: str | Column) -> Column:
    return F.trunc(time, GRAIN)


def read_gold(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}").drop("part")


def as_they_are(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    return partials


class Refresh:
    """How partials are made, merged and read: sums that only grow here, see ``Withdrawals``."""

    make = staticmethod(finest_partials)
    merge = staticmethod(merge_partials)
    partials = staticmethod(as_they_are)


def price_counts(rows: DataFrame) -> DataFrame:
    """Rows per finest key and price; rows with ``withdrawn`` count against it."""
    sign = F.when(F.col("withdrawn"), -1).otherwise(1)
    keys = [*CARRIER_KEYS, slide_bucket("event_timestamp").alias("bucket_start")]
    return rows.groupBy(*keys, "price").agg(F.sum(sign).alias("rows"))


def merge_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A price that all its rows were withdrawn from is gone."""
    return counts.groupBy(*keys, "price").agg(F.sum("rows").alias("rows")).filter("rows <> 0")


def partials_of_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The partials that the remaining rows have."""
    known = F.col("price").isNotNull()
    return counts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum(F.col("price") * F.col("rows")).alias("sum_price"),
        F.sum(F.when(known, F.col("rows")).otherwise(0)).alias("n_price"),
    ).filter("rows <> 0")


class Withdrawals:
    """Partials that can shrink: how many rows have which price, since a minimum cannot be subtracted."""

    make = staticmethod(price_counts)
    merge = staticmethod(merge_counts)
    partials = staticmethod(partials_of_counts)


def merge_into_parts(
    batch: DataFrame, keys: Sequence[str], parts: Sequence[str], folder: str, batch_id: int, how=Refresh
) -> DataFrame:
    """Merge a batch's partials (with ``part``) into the stored ones of its parts; gives the merged ones."""
    batch = how.merge(batch, [*keys, "part"])
    stored = read_generation(batch.sparkSession, folder, batch.schema, parts, batch_id)
    merged = how.merge(batch.unionByName(stored), [*keys, "part"]).persist()
    write_generation(merged, folder, parts, batch_id)
    return merged


def publish(table: DataFrame, folder: str, parts: Sequence[str]) -> None:
    """Replace the parts of a summary table; those without rows go."""
    spark = table.sparkSession
    kept = table.persist()
    try:
        overwrite_partitions(kept, folder, ["part"])
        left = {str(r["part"]) for r in kept.select("part").distinct().collect()}
    finally:
        kept.unpersist()
    for part in set(parts) - left:
        remove(spark, f"{folder}/part={part}")


def months_around(months: Sequence[date]) -> list[date]:
    return sorted({m for d in months for m in (prior_month(d), d, next_month(d))})


def prior_month(day: date) -> date:
    return (day.replace(day=1) - timedelta(days=1)).replace(day=1)


def next_month(day: date) -> date:
    return (day.replace(day=1) + timedelta(days=31)).replace(day=1)


def refresh_parts(batch: DataFrame, batch_id: int, folder: str, how=Refresh) -> None:
    """Bring the three tables up to date with one batch of unique clean rows.

    The tables are replaced one after the other: a reader in between sees the newest batch in some.
    """
    spark = batch.sparkSession
    kept = how.make(batch).withColumns(
        {"travel_part": part_of("travel_date"), "time_part": part_of("bucket_start")}
    ).persist()
    touched = kept.select("travel_part", "time_part").distinct().collect()
    travel = sorted({str(r["travel_part"]) for r in touched})
    times = sorted({r["time_part"] for r in touched})
    cached = [kept]
    try:
        by_travel = kept.withColumnRenamed("travel_part", "part").drop("time_part")
        merged = merge_into_parts(by_travel, CARRIER_KEYS, travel, f"{folder}/partials/travel", batch_id, how)
        cached.append(merged)
        for name, keys in (("route_price_analytics", ROUTE_KEYS), ("airline_price_analytics", CARRIER_KEYS)):
            partials = merge_partials(how.partials(merged, [*CARRIER_KEYS, "part"]), [*keys, "part"])
            publish(finish_partials(partials, [*keys, "part"]), f"{folder}/{name}", travel)

        window_keys = (*WINDOW_KEYS, "bucket_start")
        by_time = kept.withColumnRenamed("time_part", "part").drop("travel_part")
        names = [str(t) for t in times]
        merged = merge_into_parts(by_time, window_keys, names, f"{folder}/partials/time", batch_id, how)
        cached.append(merged)
        # The windows of a bucket may start in the part before its own, and may end in the one after.
        starts = sorted({str(m) for t in times for m in (prior_month(t), t)})
        beside = sorted({str(m) for m in months_around(times)} - set(names))
        others = read_generation(spark, f"{folder}/partials/time", merged.schema, beside, batch_id + 1)
        partials = how.partials(merged.unionByName(others), [*window_keys, "part"])
        table = finish_partials(window_partials(partials, WINDOW_KEYS), WINDOW_COLUMNS, count="price_observations")
        table = table.withColumn("part", part_of("window_start"))
        publish(table.filter(F.col("part").cast("string").isin(starts)), f"{folder}/price_window_analytics", starts)
    finally:
        for df in cached:
            df.unpersist()


def refresh_gold(clean: DataFrame, folder: str, fmt: str = "parquet") -> bool:
    """Recompute the three tables from the whole clean table, unless it is empty."""
    if clean.isEmpty():
        return False
    write_gold(finest_partials(clean), folder, fmt)
    return True


def write_gold(partials: DataFrame, folder: str, fmt: str = "parquet") -> None:
    kept = partials.persist()
    try:
        for name, table in gold_tables(kept).items():
            overwrite_table(table.withColumn("part", part_of(TIMES[name])), f"{folder}/{name}", fmt, ["part"])
    finally:
        kept.unpersist()
