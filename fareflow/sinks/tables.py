"""Batch writers."""

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F, types as T

from fareflow.workspace import remove, swap

FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def overwrite_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), **options: str
) -> None:
    """Replace the table, its schema included.

    A table of files is written to a sibling folder first and then moved into place, so that a
    crash leaves the old table whole and ``df`` may read the table it replaces.
    """
    writer = df.write.format(fmt).options(**options).partitionBy(*partition_by)
    if fmt not in FILE_FORMATS:
        if fmt == "delta":
            writer = writer.option("overwriteSchema", "true")
        writer.mode("overwrite").save(path)
        return
    folder, _, name = path.rstrip("/").rpartition("/")
    new = f"{folder}/.{name}-{uuid4().hex}" if folder else f".{name}-{uuid4().hex}"
    try:
        writer.save(new)
    except BaseException:
        remove(df.sparkSession, new)
        raise
    swap(df.sparkSession, new, path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions of a Parquet table that ``df`` has rows for; the others stay.

    Rows are dealt by partition, so that small ones make one file each; adaptive execution splits
    a large one among tasks.
    """
    dealt = df.hint("rebalance", *partition_by)
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def replace_own_input(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a table that ``df`` itself reads."""
    overwrite_table(df, path, fmt)


def append_table(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    df.write.format(fmt).mode("append").options(**options).save(path)


def write_unless_empty(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Overwrite the table unless there are no rows; says whether it wrote."""
    if df.isEmpty():
        return False
    overwrite_table(df, path, fmt)
    return True


def check_table(df: DataFrame, expected: T.StructType | None = None) -> DataFrame:
    """One row with row count, column count and whether names and types are as expected."""
    fields = [(f.name, f.dataType) for f in df.schema]
    wanted = fields if expected is None else [(f.name, f.dataType) for f in expected]
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {"columns": F.lit(len(fields)), "matches_expected": F.lit(fields == wanted)}
    )
