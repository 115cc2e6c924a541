"""What the text operators share: batches of bounded size, words, and the given tables."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.workspace import ship

#: Bytes of text that a Python worker handles at once (a longer single text is handled alone).
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the workers get this package with the first one."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches: Iterator[pa.RecordBatch], size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows that hold at most ``size`` bytes of ``text``, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)
