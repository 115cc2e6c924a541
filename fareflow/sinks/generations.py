"""Stored tables that micro-batches keep up to date, part by part, so that a replay changes nothing.

A table is partitioned by ``part`` and, below that, by ``upto``: the batch that wrote it. A batch reads
the newest generation before its own of the parts it touches, and writes theirs anew. A replayed batch
reads what it read at first and writes the same; older generations are removed, so a part has two at
most. Only the folders of touched parts are listed.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fareflow.sinks.tables import overwrite_partitions
from fareflow.workspace import children, remove

Combine = Callable[[DataFrame], DataFrame]


def generations(spark: SparkSession, folder: str, part: str) -> list[int]:
    names = children(spark, f"{folder}/part={part}")
    return sorted(int(n.removeprefix("upto=")) for n in names if n.startswith("upto="))


def read_generation(
    spark: SparkSession, folder: str, schema: T.StructType, parts: Sequence[str], before: int | None = None
) -> DataFrame:
    """The newest rows of the parts, as batches before ``before`` have left them."""
    paths = []
    for part in parts:
        found = [g for g in generations(spark, folder, part) if before is None or g < before]
        if found:
            paths.append(f"{folder}/part={part}/upto={found[-1]}")
    if not paths:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*[f for f in schema if f.name != "part"], T.StructField("part", schema["part"].dataType)])
    return spark.read.schema(stored).option("basePath", folder).parquet(*paths).select(*schema.names)


def part_names(spark: SparkSession, folder: str) -> list[str]:
    return sorted(n.removeprefix("part=") for n in children(spark, folder) if n.startswith("part="))


def read_table_of_generations(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The whole table as the last batch left it."""
    return read_generation(spark, folder, schema, part_names(spark, folder))


def write_generation(rows: DataFrame, folder: str, parts: Sequence[str], batch_id: int) -> None:
    """Write the parts anew; a part without rows is empty from now on."""
    spark = rows.sparkSession
    overwrite_partitions(rows.withColumn("upto", F.lit(batch_id)), folder, ["part", "upto"])
    for part in parts:
        found = generations(spark, folder, part)
        if found and found[-1] != batch_id:
            # nothing is left of this part
            rows.limit(0).drop("part").write.mode("overwrite").parquet(f"{folder}/part={part}/upto={batch_id}")
        for old in [g for g in found if g < batch_id][:-1]:
            remove(spark, f"{folder}/part={part}/upto={old}")


def upsert(batch: DataFrame, batch_id: int, folder: str, keys: Sequence[str]) -> None:
    """Rows of the batch replace stored ones with their keys; the others stay. ``batch`` has ``part``."""
    parts = [str(r["part"]) for r in batch.select("part").distinct().collect()]
    stored = read_generation(batch.sparkSession, folder, batch.schema, parts, batch_id)
    kept = stored.join(batch.select("part", *keys), ["part", *keys], "left_anti")
    write_generation(kept.select(batch.columns).unionByName(batch), folder, parts, batch_id)
