"""Writers and post-write checks."""

from fareflow.sinks.tables import (
    append_table,
    check_table,
    overwrite_partitions,
    overwrite_table,
    replace_own_input,
    write_unless_empty,
)
from fareflow.sinks.streams import append_stream, each_batch, run_to_end

__all__ = [
    "append_stream",
    "append_table",
    "check_table",
    "each_batch",
    "overwrite_partitions",
    "overwrite_table",
    "replace_own_input",
    "run_to_end",
    "write_unless_empty",
]
