"""Sliding event-time summaries."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fareflow.constants import WINDOW_SIZE_SECONDS, WINDOW_SLIDE_SECONDS
from fareflow.operators.summaries import fare_partials, finish_partials, merge_partials


def slide_bucket(time: str, slide: int = WINDOW_SLIDE_SECONDS) -> Column:
    """Start of the slide-wide bucket a time falls in."""
    return F.window(time, f"{slide} seconds").start


def windows_of_bucket(
    bucket: str, size: int = WINDOW_SIZE_SECONDS, slide: int = WINDOW_SLIDE_SECONDS
) -> Column:
    """Starts of the windows that hold a bucket, one output row each."""
    starts = [F.col(bucket) - F.expr(f"interval {n * slide} seconds") for n in range(size // slide)]
    return F.explode(F.array(*starts))


def window_partials(
    buckets: DataFrame,
    keys: Sequence[str],
    bucket: str = "bucket_start",
    size: int = WINDOW_SIZE_SECONDS,
    slide: int = WINDOW_SLIDE_SECONDS,
) -> DataFrame:
    """Bucket partials to window partials: the few bucket rows are copied, not the input."""
    spread = buckets.withColumn("window_start", windows_of_bucket(bucket, size, slide))
    merged = merge_partials(spread, ["window_start", *keys])
    end = F.col("window_start") + F.expr(f"interval {size} seconds")
    return merged.withColumn("window_end", end)


def sliding_summary(
    df: DataFrame,
    keys: Sequence[str] = ("route", "class"),
    time: str = "event_timestamp",
    price: str = "price",
    size: int = WINDOW_SIZE_SECONDS,
    slide: int = WINDOW_SLIDE_SECONDS,
) -> DataFrame:
    """Min, max, average price and count per sliding window and key.

    When the size is a multiple of the slide, rows are first reduced to slide-wide buckets
    and only those partials are copied into their windows.
    """
    out = ["window_start", "window_end", *keys]
    if size % slide:
        span = F.window(time, f"{size} seconds", f"{slide} seconds").alias("span")
        merged = fare_partials(df, [span, *keys], price).select(
            "*", F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end")
        )
    else:
        timed = df.filter(F.col(time).isNotNull())
        buckets = fare_partials(timed, [slide_bucket(time, slide).alias("bucket_start"), *keys], price)
        merged = window_partials(buckets, keys, "bucket_start", size, slide)
    return finish_partials(merged, out, price, count="price_observations")
