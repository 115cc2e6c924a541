"""Message logs: envelope (topic, partition, offset, value), JSON payload, offsets.

``fmt='kafka'`` reads a broker where Spark's connector is installed; any other format reads
a table or folder of envelope rows.
"""

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fareflow.schemas import ENVELOPE, PAYLOAD


def offsets_option(offsets: DataFrame | None) -> str:
    """Kafka's ``startingOffsets`` text. One row per topic partition, so it fits a driver.

    Kafka wants every partition of a topic named: add those that the topic has gained since, with
    offset 0, to the saved ones before the read (``with_new_partitions``).
    """
    rows = [] if offsets is None else offsets.collect()
    if not rows:
        return "earliest"
    topics: dict[str, dict[str, int]] = {}
    for row in rows:
        topics.setdefault(row["topic"], {})[str(row["partition"])] = row["next_offset"]
    return json.dumps(topics, sort_keys=True)


def read_log(
    spark: SparkSession, offsets: DataFrame | None = None, fmt: str = "kafka", **options: str
) -> DataFrame:
    """Bounded read from the saved offsets, or from the start, to the present end."""
    if fmt == "kafka":
        bounds = {"startingOffsets": offsets_option(offsets), "endingOffsets": "latest"}
        return spark.read.format(fmt).options(**options).options(**bounds).load()
    log = spark.read.format(fmt).schema(ENVELOPE).options(**options).load()
    return log if offsets is None else read_from_offsets(log, offsets)


def stream_log(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """The log as a stream; the checkpoint keeps the position."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    else:
        reader = reader.schema(ENVELOPE)
    return reader.options(**options).load()


def read_from_offsets(log: DataFrame, offsets: DataFrame) -> DataFrame:
    """Rows at or past the saved next offset; partitions not saved start at 0."""
    saved = offsets.select("topic", "partition", "next_offset")
    unread = F.col("offset") >= F.coalesce("next_offset", F.lit(0))
    return log.join(saved, ["topic", "partition"], "left").filter(unread).drop("next_offset")


def next_chunk(log: DataFrame, offsets: DataFrame | None, limit: int) -> DataFrame:
    """Of each topic partition the unread rows of the next ``limit`` offsets.

    They count from the first unread offset that there is, so gaps in the numbers do no harm. The least saved
    offset is a filter that reaches the scan.
    """
    if offsets is not None:
        least = offsets.agg(F.min("next_offset")).first()[0]
        known = offsets.select("topic", "partition").distinct().count()
        if known == log.select("topic", "partition").distinct().count():
            log = log.filter(F.col("offset") >= F.lit(least))
        log = read_from_offsets(log, offsets)
    first = log.groupBy("topic", "partition").agg(F.min("offset").alias("first_offset"))
    near = log.join(first, ["topic", "partition"]).filter(F.col("offset") < F.col("first_offset") + limit)
    return near.drop("first_offset")


def next_offsets(log: DataFrame) -> DataFrame:
    """Exclusive next offset per topic partition of the rows just read."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def merge_offsets(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Saved offsets after a batch; a partition without new rows keeps its old offset."""
    both = previous.select(current.columns).unionByName(current)
    return both.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


def decode_payload(
    log: DataFrame, schema: T.StructType = PAYLOAD, value: str = "value"
) -> DataFrame:
    """JSON values to flat columns. Malformed JSON or a wrong type gives NULL fields.

    ``inline`` keeps later filters above the decoding; pushed below it, each of them would
    parse the text again.
    """
    return log.select(F.inline(F.array(F.from_json(F.col(value).cast("string"), schema))))


def with_new_partitions(offsets: DataFrame, partitions: DataFrame) -> DataFrame:
    """Saved offsets for all present (topic, partition) rows; new partitions start at 0."""
    present = partitions.select("topic", "partition").distinct()
    joined = present.join(offsets.select("topic", "partition", "next_offset"), ["topic", "partition"], "left")
    return joined.withColumn("next_offset", F.coalesce("next_offset", F.lit(0).cast("long")))


def encode_payload(columns: Sequence[str]) -> Column:
    """The named columns as one JSON message value."""
    return F.to_json(F.struct(*columns))
