"""Stream-to-table jobs. Each takes all available input, then stops; a rerun resumes.

``folder`` holds the job's output and checkpoint and must be one all executors reach.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from fareflow.constants import WATERMARK
from fareflow.operators.validity import Rules, flag_invalid, live_rules
from fareflow.plans.gold import Refresh, part_of, refresh_parts
from fareflow.plans.live import clean_live, shape_live
from fareflow.sinks.generations import read_table_of_generations, upsert
from fareflow.sinks.streams import append_stream, each_batch, run_to_end
from fareflow.sinks.tables import overwrite_table
from fareflow.sources.message_log import decode_payload, merge_offsets, next_chunk, next_offsets
from fareflow.sources.tables import read_table
from fareflow.streaming.dedup import drop_repeats
from fareflow.streaming.windows import stream_windows
from fareflow.workspace import children, remove


def ingest_log(log: DataFrame, folder: str) -> StreamingQuery:
    """Message log to parsed rows; one output folder per micro-batch, so replays repeat it."""

    def store(batch: DataFrame, batch_id: int) -> None:
        overwrite_table(batch, f"{folder}/rows/batch_id={batch_id}")

    return run_to_end(each_batch(decode_payload(log), store, f"{folder}/checkpoint"))


def follow_log(log: DataFrame, folder: str, limit: int) -> bool:
    """One bounded step over a stored log: the next ``limit`` offsets of every partition.

    Rows and the offsets after them are stored per step; the offsets come last, so a step that was cut
    short is done again and replaces its rows. Says whether there was anything to read.
    """
    spark = log.sparkSession
    steps = [int(n.removeprefix("step=")) for n in children(spark, f"{folder}/offsets") if n.startswith("step=")]
    step = max(steps, default=-1) + 1
    saved = read_table(spark, f"{folder}/offsets/step={step - 1}") if step else None
    rows = f"{folder}/rows/step={step}"
    overwrite_table(next_chunk(log, saved, limit), rows)
    taken = read_table(spark, rows)
    if taken.isEmpty():
        remove(spark, rows)
        return False
    after = next_offsets(taken)
    overwrite_table(after if saved is None else merge_offsets(saved, after), f"{folder}/offsets/step={step}")
    return True


def run_clean(payload: DataFrame, folder: str) -> StreamingQuery:
    """Payload stream to the clean table."""
    writer = append_stream(clean_live(payload), f"{folder}/rows", f"{folder}/checkpoint")
    return run_to_end(writer)


def run_windows(clean: DataFrame, folder: str, keys: Sequence[str] = ("event_id",)) -> StreamingQuery:
    """Clean stream, each event once, to the table of closed windows."""
    unique = drop_repeats(clean, keys)
    writer = append_stream(stream_windows(unique, delay=None), f"{folder}/rows", f"{folder}/checkpoint")
    return run_to_end(writer)


WINDOW_ROWS = ("window_start", "route", "class")


def run_open_windows(unique: DataFrame, folder: str, delay: str = WATERMARK) -> StreamingQuery:
    """Unique clean stream to the table of all windows, those still open included.

    In update mode a batch brings every window it changed with its present values; they replace
    the stored rows of their keys, and a replayed batch does so again from the same start.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.withColumn("part", part_of("window_start")), batch_id, f"{folder}/rows", WINDOW_ROWS)

    return run_to_end(each_batch(stream_windows(unique, delay=delay), store, f"{folder}/checkpoint", "update"))


def read_windows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The table of windows; ``schema`` is that of ``stream_windows``."""
    stored = T.StructType([*schema, T.StructField("part", T.DateType())])
    return read_table_of_generations(spark, f"{folder}/rows", stored).drop("part")


def run_quarantine(payload: DataFrame, folder: str, rules: Rules | None = None) -> StreamingQuery:
    """Payload stream to kept and rejected rows, the latter with the rules they fail, and counters.

    A batch is written in one pass, to a folder of its own that a replay replaces. The counters
    are observed on the rows as they are written.
    """
    rules = live_rules() if rules is None else rules

    def store(batch: DataFrame, batch_id: int) -> None:
        flagged = flag_invalid(shape_live(batch), rules)
        verdict = F.when(F.size("failed_rules") > 0, "rejected").otherwise("kept")
        seen = Observation(f"batch-{batch_id}")
        failed = {n: F.count_if(F.array_contains("failed_rules", n)) for n in rules}
        observed = flagged.withColumn("verdict", verdict).observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.size("failed_rules") == 0).alias("kept"),
            *[c.alias(n) for n, c in failed.items()],
        )
        overwrite_table(observed, f"{folder}/rows/batch_id={batch_id}", partition_by=["verdict"])
        counters = [(name, value) for name, value in seen.get.items()]
        table = batch.sparkSession.createDataFrame(counters, "counter string, value long")
        overwrite_table(table, f"{folder}/counters/batch_id={batch_id}")

    return run_to_end(each_batch(payload, store, f"{folder}/checkpoint"))


def refresh_gold_stream(
    clean: DataFrame, folder: str, keys: Sequence[str] = ("event_id",), mode: str = "bounded", how=Refresh
) -> StreamingQuery:
    """Keep the summary tables up to date, each event counted once.

    A batch is merged with the partials of the months it touches; only those are written again. With
    ``how=Withdrawals`` rows may have ``withdrawn``, which takes an event out again; it belongs to the keys then.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        refresh_parts(batch, batch_id, folder, how)

    unique = drop_repeats(clean, keys, mode=mode)
    return run_to_end(each_batch(unique, refresh, f"{folder}/checkpoint"))
