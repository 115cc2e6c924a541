"""Dataset profiles in long form, from few passes over the data.

``column_stats`` is one scan without a shuffle of rows; ``value_counts`` is one aggregation
that answers every question about string values.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from fareflow.functions import known_number, strip_all_space
from fareflow.operators.ranking import top_per_group

HIGH_CARDINALITY = 100
TOP_VALUES = 5
SAMPLE_ROWS = 5


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _one_row_to_long(
    df: DataFrame, columns: list[str], metrics: Mapping[str, Column], kinds: str
) -> DataFrame:
    """Turn one row of ``metric@column`` aggregates into one row per column."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"`{m}@{c}`").cast(k).alias(m) for m, k in zip(metrics, kinds.split())],
        )
        for c in columns
    ]
    return df.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column and their share in percent (0 for an empty table)."""
    columns = df.columns
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns],
    )
    long = one.unpivot(["_rows"], columns, "column", "null_count")
    share = F.when(F.col("_rows") > 0, F.round(F.col("null_count") / F.col("_rows") * 100, 2))
    return long.select(
        "column", "null_count", F.coalesce(share, F.lit(0.0)).alias("null_percent")
    )


def numeric_stats(df: DataFrame, digits: int = 2) -> DataFrame:
    """Min, max and rounded average of every numeric column."""
    columns = numeric_columns(df)
    aggs = []
    for c in columns:
        col = known_number(df, c)
        aggs += [
            F.min(col).alias(f"min_value@{c}"),
            F.max(col).alias(f"max_value@{c}"),
            F.round(F.avg(col), digits).alias(f"avg_value@{c}"),
        ]
    metrics = dict.fromkeys(("min_value", "max_value", "avg_value"))
    return _one_row_to_long(df.agg(*aggs), columns, metrics, "double double double")


def blank_counts(df: DataFrame) -> DataFrame:
    """Empty strings, and strings of spaces only (empty ones included, tabs not)."""
    columns = string_columns(df)
    aggs = []
    for c in columns:
        col = F.col(f"`{c}`")
        aggs += [
            F.count_if(col == "").alias(f"empty_strings@{c}"),
            F.count_if(F.trim(col) == "").alias(f"blank_strings@{c}"),
        ]
    metrics = dict.fromkeys(("empty_strings", "blank_strings"))
    return _one_row_to_long(df.agg(*aggs), columns, metrics, "bigint bigint")


def value_counts(df: DataFrame) -> DataFrame:
    """Rows per value of every string column; NULL is a value."""
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value"))
        for c in string_columns(df)
    ]
    long = df.select(F.inline(F.array(*pairs)))
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def distinct_per_column(counts: DataFrame) -> DataFrame:
    """Distinct non-null values per string column, from ``value_counts``."""
    return counts.groupBy("column").agg(F.count("value").alias("distinct_values"))


def top_values(counts: DataFrame, k: int = TOP_VALUES) -> DataFrame:
    """The k most frequent values per column; equal counts go by value."""
    order = [F.desc("rows"), F.asc_nulls_first("value")]
    return top_per_group(counts, k, ["column"], order)


def distinct_values(counts: DataFrame, k: int | None = None) -> DataFrame:
    """All distinct values per column in sort order; for display at most the first ``k`` of each."""
    known = counts.filter(F.col("value").isNotNull())
    if k is not None:
        known = top_per_group(known, k, ["column"], [F.asc("value")])
    return known.select("column", "value").orderBy("column", "value")


def spelling_variants(counts: DataFrame) -> DataFrame:
    """Values that differ from another value only in case or outer space."""
    known = counts.filter(F.col("value").isNotNull())
    keyed = known.withColumn("spelling_key", F.lower(strip_all_space(F.col("value"))))
    # ``counts`` has one row per value; the counts are computed once, for the window alone.
    forms = F.count(F.lit(1)).over(Window.partitionBy("column", "spelling_key"))
    several = keyed.withColumn("_forms", forms).filter("_forms > 1")
    return several.select("column", "spelling_key", "value", "rows")


def outer_space_values(counts: DataFrame) -> DataFrame:
    """Distinct values with leading or trailing white space of any kind."""
    leading = F.coalesce(F.col("value").rlike(r"(?U)^\s"), F.lit(False))
    trailing = F.coalesce(F.col("value").rlike(r"(?U)\s$"), F.lit(False))
    flagged = counts.select(
        "column", "value", leading.alias("leading"), trailing.alias("trailing")
    )
    return flagged.filter(F.col("leading") | F.col("trailing"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each distinct row.

    Rows are told apart by 128 bits of hash over all columns and over which of them are NULL,
    so whole rows are not shuffled; two of 10^12 different rows agree with a chance of 10^-15.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    columns += [c.isNull() for c in columns]
    hashed = df.select(F.xxhash64(*columns).alias("_a"), F.xxhash64(F.lit(1), *columns[::-1]).alias("_b"))
    groups = hashed.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def column_kinds(df: DataFrame, target: str = "price") -> DataFrame:
    """Name, type and role of each column; the first rule that fits decides."""

    # The names of the roles.
    def kind(field: T.StructField) -> str:
        if field.name.lower() == target:
            return "Target Variable"
        if "duration" in field.name.lower():
            return "Duration Feature"
        by_type = (
            ((T.TimestampType, T.TimestampNTZType), "Timestamp"),
            (T.DateType, "Date"),
            (T.NumericType, "Numeric"),
            (T.StringType, "Categorical"),
        )
        return next((k for t, k in by_type if isinstance(field.dataType, t)), "Other")

    rows = [(f.name, f.dataType.simpleString(), kind(f)) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "column string, type string, kind string")


def compare_columns(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Which dataset has which column, one row per name and dataset."""
    names = sorted({c for df in datasets.values() for c in df.columns})
    rows = [(n, d, n in df.columns) for n in names for d, df in datasets.items()]
    spark = next(iter(datasets.values())).sparkSession
    return spark.createDataFrame(rows, "column string, dataset string, present boolean")


def sample_rows(df: DataFrame, *order: str, n: int = SAMPLE_ROWS) -> DataFrame:
    """A few rows to look at: any ``n``, or the first by ``order``."""
    return (df.orderBy(*order) if order else df).limit(n)


def quality_summary(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One row: rows, columns, duplicates, columns with NULLs, high-cardinality columns.

    Row, duplicate and NULL counts come from one grouping of the row hashes; give settled
    ``counts`` so that the table is not read again for the string values.
    """
    counts = value_counts(df) if counts is None else counts
    columns = [F.col(f"`{c}`") for c in df.columns]
    gaps = [c.isNull() for c in columns]
    hashes = [F.xxhash64(*columns, *gaps).alias("_a"), F.xxhash64(F.lit(1), *[*columns, *gaps][::-1]).alias("_b")]
    # Equal rows have equal gaps, so one flag per column and group is enough.
    groups = df.groupBy(*hashes).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.max(g).alias(f"_gap_{n}") for n, g in enumerate(gaps)]
    )
    missing = [F.coalesce(F.max(f"_gap_{n}"), F.lit(False)).cast("bigint") for n in range(len(gaps))]
    table = groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        sum(missing, F.lit(0).cast("bigint")).alias("columns_with_missing_values"),
    )
    wide = F.count_if(F.col("distinct_values") > HIGH_CARDINALITY).alias("high_cardinality_columns")
    parts = [table, distinct_per_column(counts).agg(wide)]
    names = [name for part in parts for name in part.columns]
    # Each part is one row; unite them in long form, so that no join is needed.
    long = [part.unpivot([], part.columns, "metric", "value") for part in parts]
    united = long[0].unionByName(long[1])
    values = [F.max(F.when(F.col("metric") == name, F.col("value"))).alias(name) for name in names]
    return united.agg(*values).select(
        "rows", F.lit(len(df.columns)).alias("columns"), *names[1:]
    )


def column_stats(df: DataFrame) -> DataFrame:
    """``(column, metric, value)`` of the null, number and blank measures, from one scan."""
    measures: list[tuple[str, str, Column]] = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        nulls = F.count_if(col.isNull())
        percent = F.round(F.try_divide(nulls, F.count(F.lit(1))) * 100, 2)
        found = {"null_count": nulls, "null_percent": F.coalesce(percent, F.lit(0.0))}
        if isinstance(field.dataType, T.NumericType):
            value = known_number(df, field.name)
            found["min_value"] = F.min(value).cast("double")
            found["max_value"] = F.max(value).cast("double")
            found["avg_value"] = F.round(F.avg(value), 2)
        if isinstance(field.dataType, T.StringType):
            found["empty_strings"] = F.count_if(col == "")
            found["blank_strings"] = F.count_if(F.trim(col) == "")
        measures += [(field.name, metric, value) for metric, value in found.items()]
    one = df.agg(*[v.cast("string").alias(f"{m}@{c}") for c, m, v in measures])
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(m).alias("metric"), F.col(f"`{m}@{c}`").alias("value")
        )
        for c, m, _ in measures
    ]
    return one.select(F.inline(F.array(*rows)))


def _metrics(df: DataFrame, *names: str) -> DataFrame:
    """Rows ``(column, metric, value as text)`` of the named measures."""
    texts = df.select("column", *[F.col(n).cast("string").alias(n) for n in names])
    return texts.unpivot(["column"], list(names), "metric", "value")


def dataset_profile(
    df: DataFrame, counts: DataFrame | None = None, sample: DataFrame | None = None
) -> DataFrame:
    """The whole profile as ``(column, metric, value)``.

    Column measures, all distinct values, the most frequent ones, spelling variants, outer space,
    types and roles, the quality summary, and on demand the rows of ``sample``. Give ``counts``
    from a settled ``value_counts`` to group the string values only once.
    """
    counts = value_counts(df) if counts is None else counts
    ranked = top_values(counts).select(
        "column",
        F.concat(F.lit("top_value_"), F.col("rank")).alias("metric"),
        F.concat_ws(" x", F.coalesce("value", F.lit("NULL")), F.col("rows")).alias("value"),
    )
    summary = quality_summary(df, counts).withColumn("column", F.lit("*"))
    names = [c for c in summary.columns if c != "column"]
    values = counts.filter(F.col("value").isNotNull()).select(
        "column", F.lit("distinct_value").alias("metric"), "value"
    )
    variants = spelling_variants(counts).select(
        "column",
        F.lit("spelling_variant").alias("metric"),
        F.concat("spelling_key", F.lit(": "), "value", F.lit(" x"), F.col("rows")).alias("value"),
    )
    sides = F.concat_ws("+", F.when(F.col("leading"), "leading"), F.when(F.col("trailing"), "trailing"))
    spaced = outer_space_values(counts).select(
        "column", F.lit("outer_space").alias("metric"), F.concat(sides, F.lit(": "), "value").alias("value")
    )
    shown = [] if sample is None else [sample_texts(sample)]
    united = (
        column_stats(df)
        .unionByName(_metrics(distinct_per_column(counts), "distinct_values"))
        .unionByName(ranked)
        .unionByName(_metrics(column_kinds(df), "type", "kind"))
        .unionByName(_metrics(summary, *names))
        .unionByName(values)
        .unionByName(variants)
        .unionByName(spaced)
    )
    for part in shown:
        united = united.unionByName(part)
    return united


def sample_texts(sample: DataFrame) -> DataFrame:
    """Sample rows in the profile's form: the values with bars between them."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")) for c in sample.columns]
    return sample.select(
        F.lit("*").alias("column"), F.lit("sample_row").alias("metric"), F.concat_ws("|", *texts).alias("value")
    )
