"""Exact histogram of encoded lengths, and suffix sums over it.

The vocabulary file is read where the job is started and sent along: its size is checked against
``VOCABULARY_BYTES``. Documents are counted per length in each task, so a histogram of distinct
lengths is all that is shuffled. Suffix sums run within blocks of lengths and over the totals of
the blocks, so no task has all lengths.

Rows: null and empty texts have length 0; very long texts are encoded whole, part by part; repeated
rows count each; equal lengths are one row; empty input gives an empty histogram. Columns besides ``text`` are not looked at.
"""

import base64
import re
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.texts import pieces
from fareflow.workspace import settle

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VOCABULARY_BYTES = 32 << 20
#: Fixed value: the pattern that splits text for this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPLIT = regex.compile(PATTERN)
#: Longer texts are encoded in parts, cut before a single space between two words, where the pattern cuts too.
PART = 1 << 16
CUT = re.compile(r"(?<=\S)\x20(?=[^\W\d_])")
BLOCK = 1 << 10

_encodings: dict[int, tiktoken.Encoding] = {}


def encoding(ranks: bytes) -> tiktoken.Encoding:
    """The tokenizer of a rank file; a worker builds it once."""
    key = hash(ranks)
    if key not in _encodings:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encodings[key]


def part_length(tokenizer: tiktoken.Encoding, text: str) -> int:
    """Tokens of a part; one that could not be cut is split by the pattern here, not in the tokenizer.

    The tokenizer's own splitter needs a stack frame per character of white space and gives up on
    runs of a million; its encoder takes single pieces of any length.
    """
    if len(text) <= 4 * PART:
        return len(tokenizer.encode_ordinary(text))
    return sum(len(tokenizer._encode_single_piece(found.group())) for found in SPLIT.finditer(text))


def encoded_length(tokenizer: tiktoken.Encoding, text: str) -> int:
    total, start = 0, 0
    while len(text) - start > PART:
        found = CUT.search(text, start + PART)
        if not found:
            break
        total += part_length(tokenizer, text[start : found.start()])
        start = found.start()
    return total + part_length(tokenizer, text[start:] if start else text)


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    ranks = Path(path).read_bytes()
    if len(ranks) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return ranks


def length_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """length and docs: how many rows have which encoded length."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(shared.value)
        for part in pieces(batches):
            lengths = [encoded_length(tokenizer, t) if t else 0 for t in part.column("text").to_pylist()]
            values, docs_with = np.unique(np.array(lengths, dtype=np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(docs_with.astype(np.int64))], names=["length", "docs"])

    counted = docs.select("text").mapInArrow(count, "length long, docs long")
    return counted.groupBy("length").agg(F.sum("docs").alias("docs"))


def suffix_sums(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per length: docs, and of documents at least as long their number and tokens; totals too.

    ``truncated_tokens`` is the total if texts were cut at this length; between two lengths it
    grows by ``docs_from`` of the upper one per token. ``share`` is the share of documents that
    are no longer, which answers quantiles.
    """
    tokens = F.col("length") * F.col("docs")
    # Read twice below: the texts must not be encoded twice.
    rows = settle(counts, "lengths").withColumn("tokens", tokens).withColumn("block", F.floor(F.col("length") / block))
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(everything).alias("total_docs"),
        F.sum("t").over(everything).alias("total_tokens"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("length"))
    docs_from = F.sum("docs").over(within) + F.col("docs_above")
    tokens_from = F.sum("tokens").over(within) + F.col("tokens_above")
    out = rows.join(blocks, "block").select(
        "length", "docs", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"), "total_docs", "total_tokens"
    )
    cut = F.col("total_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from")
    share = (F.col("total_docs") - F.col("docs_from") + F.col("docs")) / F.col("total_docs")
    return out.withColumn("truncated_tokens", cut).withColumn("share", share)


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    return suffix_sums(length_counts(docs, vocabulary))


def at_limits(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """limit, docs_cut and truncated_tokens for any given context limits."""
    rows = histogram.select("length", "docs", F.explode(F.array(*map(F.lit, limits))).alias("limit"))
    longer = F.when(F.col("length") > F.col("limit"), F.col("docs")).otherwise(0)
    return rows.groupBy("limit").agg(
        F.sum(longer).alias("docs_cut"), F.sum(F.least("length", "limit") * F.col("docs")).alias("truncated_tokens")
    )


def quantiles(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """share and the smallest length that at least this share of documents does not exceed."""
    rows = histogram.select("length", F.col("share").alias("at"), F.explode(F.array(*map(F.lit, shares))).alias("share"))
    return rows.filter("at >= share").groupBy("share").agg(F.min("length").alias("length"))
