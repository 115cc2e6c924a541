"""Row-local standardisation: no operator here shuffles."""

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fareflow import functions as X
from fareflow.constants import CARRIER_NAMES, HISTORY_STOPS
from fareflow.schemas import CANONICAL


def add_lineage(
    df: DataFrame, loaded_at: datetime | None = None, **constants: str
) -> DataFrame:
    """Constant source columns and the load time (now, unless one is given)."""
    time = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    labels = {name: F.lit(value) for name, value in constants.items()}
    return df.withColumns({**labels, "ingestion_timestamp": time})


def first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of the candidate names that is a column, by exact spelling."""
    return next((name for name in names if name in df.columns), None)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Ordered select with casts; columns that ``df`` lacks become typed NULLs."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def check_schema(df: DataFrame, expected: T.StructType, types: bool = True) -> DataFrame:
    """``df`` itself, or ValueError when ordered names (and types) differ."""
    want = [(f.name, f.dataType.simpleString() if types else "") for f in expected]
    have = [(f.name, f.dataType.simpleString() if types else "") for f in df.schema]
    if want != have:
        raise ValueError(f"schema mismatch\nexpected: {want}\nactual:   {have}")
    return df


def coerce(df: DataFrame, **kinds: str) -> DataFrame:
    """Try to cast the named columns; values that do not fit become NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in kinds.items()})


def carrier_name(col: Column, names: Mapping[str, str] = CARRIER_NAMES) -> Column:
    return X.recode(col, names, F.trim(col))


def stops_count(
    col: Column, labels: Mapping[str, int], unmatched: int | None, fold: bool = True
) -> Column:
    """Stops label to count; ``unmatched`` answers for labels not listed and for NULL."""
    return X.recode(col, labels, F.lit(unmatched).cast("int"), fold)


def canonical_history(raw: DataFrame, source: str = "historical") -> DataFrame:
    """Raw history rows to the canonical 15 columns, in one projection."""
    renamed = raw.drop("_c0").withColumnsRenamed({"flight": "flight_code", "class": "cabin_class"})
    places = ("source_city", "destination_city", "departure_time", "arrival_time")
    cleaned = renamed.withColumns(
        {
            **X.trimmed("flight_code", *places, "cabin_class"),
            "airline": carrier_name(F.col("airline")),
            "stops": stops_count(F.col("stops"), HISTORY_STOPS, None),
            "duration_minutes": X.rounded_minutes(F.col("duration")),
            "price": X.positive_or_null(F.col("price")),
            "source": F.lit(source),
        }
    )
    return conform(cleaned, CANONICAL)


def training_rows(canonical: DataFrame) -> DataFrame:
    """Model input: the eleven feature and target columns of rows with a usable price."""
    left_out = {"departure_date", "arrival_date", "source", "ingestion_timestamp"}
    features = [f.name for f in CANONICAL if f.name not in left_out]
    return canonical.filter(F.col("price") > 0).select(*features)


def baseline_rows(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw history prepared for the price baseline; ``keep`` carries row-order columns."""
    texts = ("airline", "source_city", "destination_city", "cabin_class")
    # Rows without a text go first, on the columns as stored, so the scan can skip them.
    stored = raw.withColumnsRenamed({"class": "cabin_class"}).dropna(subset=list(texts[1:]))
    prepared = stored.select(
        *[X.free_text_key(F.col(c)).alias(c) for c in texts],
        stops_count(F.col("stops"), HISTORY_STOPS, 2, fold=False).alias("stops"),
        X.exact_minutes(F.col("duration")).alias("duration_minutes"),
        F.col("days_left").try_cast("double").alias("days_left"),
        F.col("price").try_cast("double").alias("price"),
        *keep,
    )
    return prepared.dropna(subset=["duration_minutes", "days_left", "price"])
