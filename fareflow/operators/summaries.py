"""Grouped and global fare summaries."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fareflow.functions import known_number
from fareflow.workspace import settle

#: Ranges that a key's values are cut into, values that are few enough to be put in order, and turns.
BUCKETS, FEW_VALUES, MOST_TURNS = 256, 1024, 64
#: Logarithm of the cells of a sketch: a standard error of about 0.8 %.
SKETCH_BITS = 14
HISTORY_AVERAGES = ("duration_minutes", "days_left", "stops")


def fare_summary(
    df: DataFrame,
    keys: Sequence[str],
    price: str = "price",
    averages: Sequence[str] = HISTORY_AVERAGES,
    digits: int = 2,
    count: str = "flight_count",
) -> DataFrame:
    """Row count, average, min and max price per key, and averages of further columns."""
    value = known_number(df, price)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count),
        F.round(F.avg(value), digits).alias("avg_price"),
        F.min(value).alias("min_price"),
        F.max(value).alias("max_price"),
        *[F.round(F.avg(known_number(df, c)), digits).alias(f"avg_{c}") for c in averages],
    )


def fare_partials(
    df: DataFrame,
    keys: Sequence[str | Column],
    price: str = "price",
    averages: Sequence[str] = (),
) -> DataFrame:
    """Mergeable state of ``fare_summary``: counts, sums, min and max per key."""
    sums = []
    for c in (price, *averages):
        value = known_number(df, c)
        sums += [F.sum(value).alias(f"sum_{c}"), F.count(value).alias(f"n_{c}")]
    value = known_number(df, price)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(value).alias("min_price"),
        F.max(value).alias("max_price"),
        *sums,
    )


def merge_partials(partials: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Merge partials of several batches, or roll them up to fewer keys."""
    sums = [c for c in partials.columns if c == "rows" or c.startswith(("sum_", "n_"))]
    return partials.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
    )


def finish_partials(
    partials: DataFrame,
    keys: Sequence[str],
    price: str = "price",
    averages: Sequence[str] = (),
    digits: int = 2,
    count: str = "flight_count",
) -> DataFrame:
    """The columns of ``fare_summary`` from merged partials."""

    def mean(c: str) -> Column:
        return F.round(F.try_divide(F.col(f"sum_{c}").cast("double"), F.col(f"n_{c}")), digits)

    return partials.select(
        *keys,
        F.col("rows").alias(count),
        mean(price).alias("avg_price"),
        "min_price",
        "max_price",
        *[mean(c).alias(f"avg_{c}") for c in averages],
    )


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Average of a column per key; over a table of averages this is the average of them."""
    return df.groupBy(*keys).agg(F.avg(known_number(df, value)).alias(name))


def current_fares(df: DataFrame, key: str = "route", price: str = "price") -> DataFrame:
    """Mean, min, max and number of known prices per key, dearest first."""
    value = known_number(df, price)
    stats = df.groupBy(key).agg(
        F.round(F.avg(value), 2).alias("avg_price"),
        F.round(F.min(value), 2).alias("min_price"),
        F.round(F.max(value), 2).alias("max_price"),
        F.count(value).alias("observations"),
    )
    return stats.orderBy(F.desc_nulls_last("avg_price"), key)


def global_stats(df: DataFrame, price: str = "price") -> DataFrame:
    value = known_number(df, price)
    return df.agg(
        F.avg(value).alias("avg_price"),
        F.min(value).alias("min_price"),
        F.max(value).alias("max_price"),
    )


def counts_in_one_scan(
    df: DataFrame,
    groups: Mapping[str, Sequence[str]],
    filters: Mapping[str, Column],
    values: Mapping[str, Column],
) -> DataFrame:
    """``(metric, value)``: rows, rows that pass each filter, groups, distinct non-null values.

    One scan: rows are first reduced to the distinct combinations of all columns in question, with
    their counts; everything else is counted over those. NULL is a value of its own in a group.
    """
    keys = {f"_g_{n}": F.struct(*columns) for n, columns in groups.items()}
    keys |= {f"_v_{n}": column for n, column in values.items()}
    keys |= {f"_f_{n}": F.coalesce(column, F.lit(False)) for n, column in filters.items()}
    combined = df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.count(F.lit(1)).alias("_rows"))
    counts = [F.sum("_rows").alias("rows")]
    counts += [F.sum(F.when(F.col(f"_f_{n}"), F.col("_rows")).otherwise(0)).alias(n) for n in filters]
    # A struct is never NULL, so distinct structs are the groups.
    counts += [F.count_distinct(f"_g_{n}").alias(n) for n in groups]
    counts += [F.count_distinct(f"_v_{n}").alias(n) for n in values]
    one = combined.agg(*[F.coalesce(c, F.lit(0)).alias(name) for c, name in zip(counts, ["rows", *filters, *groups, *values])])
    return one.unpivot([], one.columns, "metric", "value")


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")
        for name, df in tables.items()
    ]
    first, *rest = counts
    for more in rest:
        first = first.unionByName(more)
    return first


def distinct_counts(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """One row per metric with its number of distinct non-null values, in one pass."""
    counts = df.agg(*[F.count_distinct(c).alias(m) for m, c in metrics.items()])
    return counts.unpivot([], list(metrics), "metric", "value")


def latest_time(df: DataFrame, column: str = "event_timestamp") -> DataFrame:
    latest = F.max(column)
    return df.agg(latest.alias("latest"), F.date_format(latest, "HH:mm:ss").alias("clock"))


def outcome_counts(df: DataFrame, status: Column, events: Column) -> DataFrame:
    """Requests and events sent per outcome."""
    return df.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("requests"), F.sum(events).alias("events_sent")
    )


def median_price(df: DataFrame, keys: Sequence[str], price: str = "price") -> DataFrame:
    """Exact median per key, by distributed selection.

    Prices are counted per key and value. For each of the one or two middle places the values of a key
    are counted in ``BUCKETS`` ranges; the range that holds the place is cut again, until it has
    few values or one. So no task holds the values of a key, however many it has.
    """
    value = known_number(df, price).cast("double")
    counts = df.groupBy(*keys, value.alias("_price")).agg(F.count(value).alias("_n"))
    counts = settle(counts, "prices")
    return picked_places(counts, keys).groupBy(*keys).agg(F.avg("_price").alias("median_price"))


def picked_places(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key the values at the lower and the upper middle place (``keys``, ``_place``, ``_price``)."""
    key = [F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)]
    names = [f"_k{n}" for n in range(len(keys))]
    rows = counts.select(*key, "_price", "_n")
    known = F.col("_price").isNotNull()
    bounds = rows.groupBy(*names).agg(
        F.coalesce(F.sum(F.when(known, F.col("_n"))), F.lit(0)).alias("_all"),
        F.min("_price").alias("_low"), F.max("_price").alias("_high"), F.count("_price").alias("_values"),
    )
    # The middle places, counted from 1, are (all + 1) / 2 rounded down and up.
    middle = (F.col("_all") + 1) / 2
    places = F.array_distinct(F.array(F.floor(middle), F.ceil(middle)))
    open_ = settle(bounds.select(
        *names, F.explode(places).alias("_place"), "_low", "_high", "_values", F.lit(0).cast("long").alias("_below")
    ), "places")
    done = None
    for turn in range(MOST_TURNS):
        closed = open_.filter(F.col("_values") <= FEW_VALUES)
        done = closed if done is None else done.unionByName(closed)
        wide = open_.filter(F.col("_values") > FEW_VALUES)
        if wide.isEmpty():
            break
        open_ = settle(narrowed(rows, wide, names, turn), "places")
    else:
        raise ValueError("the prices cannot be told apart by ranges")
    near = within(rows, done, names)
    order = Window.partitionBy(*names, "_place").orderBy("_price").rowsBetween(Window.unboundedPreceding, 0)
    upto = near.withColumn("_upto", F.sum("_n").over(order) + F.col("_below"))
    hit = (F.col("_upto") >= F.col("_place")) & (F.col("_upto") - F.col("_n") < F.col("_place"))
    found = upto.filter(hit).select(*names, "_place", "_price")
    empty = done.filter("_values = 0").select(*names, "_place", F.lit(None).cast("double").alias("_price"))
    return found.unionByName(empty).withColumnsRenamed(dict(zip(names, keys)))


def within(rows: DataFrame, places: DataFrame, names: Sequence[str]) -> DataFrame:
    """The values between the bounds of each place; NULL keys are keys."""
    here = places.withColumnsRenamed({n: f"{n}_of" for n in names})
    match = F.col("_price").between(F.col("_low"), F.col("_high"))
    for n in names:
        match = match & F.col(n).eqNullSafe(F.col(f"{n}_of"))
    return rows.join(here, match).drop(*[f"{n}_of" for n in names])


def narrowed(rows: DataFrame, places: DataFrame, names: Sequence[str], turn: int) -> DataFrame:
    """The one of ``BUCKETS`` ranges between the bounds that holds the place.

    Ranges are equally wide; every other turn they are so on a logarithmic scale from the lower bound,
    which also cuts values that crowd there.
    """
    span, at = F.col("_high") - F.col("_low"), F.col("_price") - F.col("_low")
    share = at / span if turn % 2 == 0 else F.log1p(at * 1e6 / span) / F.log1p(F.lit(1e6))
    bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    cells = within(rows, places, names).groupBy(*names, "_place", bucket.alias("_bucket"), "_below").agg(
        F.sum("_n").alias("_n"), F.min("_price").alias("_low"), F.max("_price").alias("_high"), F.count("*").alias("_values")
    )
    order = Window.partitionBy(*names, "_place").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    upto = cells.withColumn("_upto", F.sum("_n").over(order) + F.col("_below"))
    hit = (F.col("_upto") >= F.col("_place")) & (F.col("_upto") - F.col("_n") < F.col("_place"))
    return upto.filter(hit).select(
        *names, "_place", "_low", "_high", "_values", (F.col("_upto") - F.col("_n")).alias("_below")
    )


def distinct_sketches(df: DataFrame, metrics: Mapping[str, Column], keys: Sequence[str | Column]) -> DataFrame:
    """Per key a mergeable sketch of the distinct values of each metric; a few kilobytes each."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(c, F.lit(SKETCH_BITS)).alias(m) for m, c in metrics.items()])


def merge_sketches(sketches: DataFrame, metrics: Sequence[str], keys: Sequence[str | Column] = ()) -> DataFrame:
    """Sketches of several batches, or rolled up to fewer keys."""
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(m).alias(m) for m in metrics])


def sketch_estimates(sketches: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``keys``, metric and the estimated number of distinct values."""
    counts = sketches.select(*keys, *[F.hll_sketch_estimate(m).alias(m) for m in metrics])
    return counts.unpivot([*keys], list(metrics), "metric", "estimate")
