"""Readers: files, tables, message logs, SQL text."""

from fareflow.sources.message_log import (
    decode_payload,
    encode_payload,
    merge_offsets,
    next_offsets,
    offsets_option,
    read_from_offsets,
    read_log,
    stream_log,
)
from fareflow.sources.tables import (
    active_snapshot,
    query_over,
    read_delimited,
    read_or_empty,
    read_parts,
    read_table,
    rows_to_frame,
    spread,
    stream_table,
    union_parts,
)

__all__ = [
    "active_snapshot",
    "decode_payload",
    "encode_payload",
    "merge_offsets",
    "next_offsets",
    "offsets_option",
    "query_over",
    "read_delimited",
    "read_from_offsets",
    "read_log",
    "read_or_empty",
    "read_parts",
    "read_table",
    "rows_to_frame",
    "spread",
    "stream_log",
    "stream_table",
    "union_parts",
]
