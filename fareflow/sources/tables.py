"""Batch and streaming table readers."""

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """Delimited text with a header row. A declared schema saves the inference pass."""
    reader = spark.read.option("header", True).options(**options)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a table of fewer files than there are cores; else ``df`` as it is.

    For work that costs far more than the scan. ``keys`` should tell rows apart. Files count, not scan
    tasks: a file is planned as many tasks, of which those without the start of a row group read nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    files = df.inputFiles()
    few = len(files) < cores if files else df.rdd.getNumPartitions() == 1
    return df.repartition(cores, *keys) if few else df


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Tail a table: files added later arrive in later micro-batches."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """The table, or an empty one of this schema when nothing was written yet."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_parts(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Several files or folders of one table in a single scan, with the columns of all of them.

    Parquet footers are merged; other formats are read one by one and united by name.
    """
    if fmt == "parquet":
        return spark.read.option("mergeSchema", True).parquet(*paths)
    return union_parts([spark.read.format(fmt).load(path) for path in paths])


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns a part lacks are NULL."""
    first, *rest = parts
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rest, first.select("*"))


def rows_to_frame(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    """A few rows from memory, typed by a declared schema."""
    return spark.createDataFrame(rows, schema)


def query_over(text: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text over named DataFrames: ``query_over("select * from {t}", t=df)``."""
    spark = next(iter(tables.values())).sparkSession
    return spark.sql(text, **tables)


def active_snapshot(
    actions: DataFrame,
    key: str = "path",
    order: Sequence[str] = ("version", "seq"),
    action: str = "action",
    keep: str = "add",
) -> DataFrame:
    """Keys whose last action in the change log is ``keep``, with that action's position.

    One aggregation with map-side partials, so a key with very many actions stays cheap.
    """
    last = F.max_by(F.col(action), F.struct(*order)).alias(action)
    position = F.max(F.struct(*order)).alias("position")
    latest = actions.groupBy(key).agg(last, position).filter(F.col(action) == keep)
    return latest.select(key, action, "position.*")
