"""Structured Streaming forms of the live jobs."""

from fareflow.streaming.dedup import LateRows, count_late_rows, drop_repeats, only_batches_of_rows, state_on_disk
from fareflow.streaming.jobs import (
    follow_log,
    ingest_log,
    read_windows,
    refresh_gold_stream,
    run_clean,
    run_open_windows,
    run_quarantine,
    run_windows,
)
from fareflow.streaming.windows import stream_windows

__all__ = [
    "LateRows",
    "count_late_rows",
    "drop_repeats",
    "follow_log",
    "ingest_log",
    "only_batches_of_rows",
    "read_windows",
    "refresh_gold_stream",
    "run_clean",
    "run_open_windows",
    "run_quarantine",
    "run_windows",
    "state_on_disk",
    "stream_windows",
]
