"""Streaming writers. Every one needs a checkpoint folder the whole cluster can reach."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter


def append_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"
) -> DataStreamWriter:
    """Append to a table, taking all input there is and then stopping."""
    return (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )


def each_batch(
    df: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> DataStreamWriter:
    """Call ``work(batch, batch_id)`` for each micro-batch that has rows.

    A batch may be replayed after a failure, so ``work`` must overwrite by ``batch_id``. The
    batch is kept while it is worked on, so its rows are computed once.
    """

    def skip_empty(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            if not kept.isEmpty():
                work(kept, batch_id)
        finally:
            kept.unpersist()

    return (
        df.writeStream.foreachBatch(skip_empty)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Start the query and wait until it has taken all available input."""
    query = writer.start()
    query.awaitTermination()
    return query
