"""Duplicate removal. All forms aggregate map-side first, so a hot key stays cheap."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; which one is arbitrary."""
    return df.dropDuplicates(list(keys))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order``, ties broken by all other columns."""
    ranked = [*order, *[c for c in df.columns if c not in order and c not in keys]]
    first = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
