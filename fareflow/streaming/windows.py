"""Sliding-window price summary over a stream."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fareflow.constants import WATERMARK, WINDOW_SIZE_SECONDS, WINDOW_SLIDE_SECONDS


def stream_windows(
    clean: DataFrame,
    keys: Sequence[str] = ("route", "class"),
    time: str = "event_timestamp",
    price: str = "price",
    size: int = WINDOW_SIZE_SECONDS,
    slide: int = WINDOW_SLIDE_SECONDS,
    delay: str | None = WATERMARK,
) -> DataFrame:
    """Same columns as the batch summary; in append mode a window comes out once closed.

    Without a ``delay`` the watermark that ``clean`` already has is used.
    """
    if delay is not None:
        clean = clean.withWatermark(time, delay)
    span = F.window(time, f"{size} seconds", f"{slide} seconds").alias("span")
    grouped = clean.groupBy(span, *keys)
    stats = grouped.agg(
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.round(F.avg(price), 2).alias("avg_price"),
        F.count(F.lit(1)).alias("price_observations"),
    )
    return stats.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        *keys,
        "min_price",
        "max_price",
        "avg_price",
        "price_observations",
    )
