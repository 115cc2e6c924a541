"""Streaming duplicate removal."""

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from fareflow.constants import OFFER_KEYS, WATERMARK

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drop_repeats(
    clean: DataFrame,
    keys: Sequence[str] = OFFER_KEYS,
    time: str = "event_timestamp",
    delay: str = WATERMARK,
    mode: str = "bounded",
) -> DataFrame:
    """One row per key.

    ``bounded`` forgets a key once the watermark has passed it, so state stays small and a
    repeat that comes later than ``delay`` is let through. ``global`` remembers every key
    for ever and needs no watermark, so no row is late. A long ``delay`` is a retention: keys
    live that long after their event time, and start the job under ``state_on_disk``.
    """
    if mode == "bounded":
        return clean.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
    if mode == "global":
        return clean.dropDuplicates(list(keys))
    raise ValueError(f"mode is bounded or global, not {mode!r}")


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for the jobs started inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def state_on_disk(spark: SparkSession):
    """Jobs started inside keep their state in RocksDB, on disk, instead of in the executors' heap.

    A checkpoint stays with the store that it was made with.
    """
    return setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def only_batches_of_rows(spark: SparkSession):
    """Jobs started inside end without the batch that has no rows and only moves the watermark on."""
    return setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false")


class LateRows(StreamingQueryListener):
    """Adds up, per run, the rows that stateful operators dropped for being older than the watermark.

    Every progress report is counted as it comes; a query's own list keeps only the last ones.
    """

    def __init__(self) -> None:
        self.counts: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def end_of(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run_id = str(event.progress.runId)
        late = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self.counts[run_id] = self.counts.get(run_id, 0) + late

    def onQueryTerminated(self, event) -> None:
        self.end_of(str(event.runId)).set()


def count_late_rows(spark: SparkSession, run: Callable[[], StreamingQuery], wait: float = 60.0) -> int:
    """Run a stream to its end and count the rows it dropped as late, over all its batches."""
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        run_id = str(run().runId)
        if not listener.end_of(run_id).wait(wait):
            raise TimeoutError("the end of the stream was not reported")
        return listener.counts.get(run_id, 0)
    finally:
        spark.streams.removeListener(listener)
