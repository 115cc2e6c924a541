"""Find benchmark passages in documents with an FM-index per shard of documents.

A shard is a few MB of documents in one task. Its word runs that consist of benchmark words only,
and are long enough for a phrase, are written one after the other as symbols; equal runs are
written once. The shard's index is the wavelet matrix of the Burrows-Wheeler transform with
sampled suffix positions. All phrases are searched at once, backward, and their rows are walked
to the next sampled position. Hit positions merge to removal spans.

A benchmark larger than ``BLOCK_BYTES`` is searched block by block, in one pass over the documents
each, with the hits so far written in between; one block at a time is broadcast, so what is
broadcast has that bound.

Rows: a null or empty text has no words and no hits; repeated rows are handled one by one; items
without words have no window; an item without id marks words but is in no item list; an empty
benchmark leaves every document clean; empty documents give an empty result. Columns besides
``doc_id`` and ``text`` (``item_id`` and ``text``) are not looked at.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.texts import pieces, utf8
from fareflow.workspace import settle

WINDOW = 10
BLOCK_BYTES = 16 << 20
SAMPLE = 8
FOUND = "doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<string>"

#: Bytes of words: digits, letters (A-Z lower-cased) and everything beyond ASCII; others separate.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Phrases:
    """The distinct windows of some benchmark items as symbols, and the items of each window."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int = WINDOW):
        of: dict[tuple[bytes, ...], set[str | None]] = {}
        for item, text in items:
            words = words_of(text)
            for k in range(max(1, len(words) - width + 1) if words else 0):
                of.setdefault(tuple(words[k : k + width]), set()).add(item)
        vocabulary = sorted({w for window in of for w in window})
        self.symbol = {w: k + 2 for k, w in enumerate(vocabulary)}
        self.lengths = np.array([len(w) for w in of], dtype=np.int64)
        self.shortest = int(self.lengths.min()) if of else 0
        self.windows = np.zeros((len(of), width), dtype=np.int64)
        for k, window in enumerate(of):
            self.windows[k, : len(window)] = [self.symbol[w] for w in window]
        self.items = [sorted(x for x in names if x is not None) for names in of.values()]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that are still tied are sorted again.

    The last symbol must be smaller than all others.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    group = np.repeat(first, np.diff(np.r_[first, n]))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = group
    rows = np.arange(n)
    depth = 1
    while True:
        # rows whose group has more than one suffix
        group = rank[order[rows]]
        tied = np.r_[False, group[1:] == group[:-1]]
        rows = rows[tied | np.r_[tied[1:], False]]
        if not len(rows):
            return order
        at = order[rows]
        key = rank[at] * (n + 1) + rank[np.minimum(at + depth, n - 1)]
        by = np.argsort(key, kind="stable")
        order[rows] = at[by]
        key = key[by]
        start = np.r_[True, key[1:] != key[:-1]]
        rank[at[by]] = rows[np.maximum.accumulate(np.where(start, np.arange(len(rows)), 0))]
        depth *= 2


class ShardIndex:
    """FM-index of a symbol sequence: backward search and positions."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        order = suffix_order(symbols)
        self.n, self.sample = len(symbols), sample
        self.levels: list[tuple[int, np.ndarray, int]] = []
        row = symbols[order - 1]
        for bit in reversed(range(int(symbols.max()).bit_length())):
            ones = (row >> bit & 1).astype(bool)
            self.levels.append((bit, np.r_[0, np.cumsum(ones, dtype=np.int32)], self.n - int(ones.sum())))
            row = np.concatenate((row[~ones], row[ones]))
        self.before = np.r_[0, np.cumsum(np.bincount(symbols))]
        sampled = order % sample == 0
        self.marks = np.r_[0, np.cumsum(sampled, dtype=np.int32)]
        self.positions = order[sampled]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform above each row."""
        low = np.zeros_like(row)
        for bit, ones, zeros in self.levels:
            up = (symbol >> bit & 1).astype(bool)
            low = np.where(up, zeros + ones[low], low - ones[low])
            row = np.where(up, zeros + ones[row], row - ones[row])
        return row - low

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that is one symbol longer to the left."""
        symbol, at, low = np.zeros_like(row), row, np.zeros_like(row)
        for bit, ones, zeros in self.levels:
            up = (ones[at + 1] - ones[at]).astype(bool)
            symbol = symbol | up.astype(np.int64) << bit
            low = np.where(up, zeros + ones[low], low - ones[low])
            at = np.where(up, zeros + ones[at], at - ones[at])
        return self.before[symbol] + at - low

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per window the first and the last-plus-one row of the suffixes that begin with it."""
        low, high = np.zeros(len(windows), dtype=np.int64), np.full(len(windows), self.n, dtype=np.int64)
        alive = np.arange(len(windows))
        for step in range(int(lengths.max())):
            alive = alive[lengths[alive] > step]
            symbol = windows[alive, lengths[alive] - 1 - step]
            symbol_known = symbol < len(self.before) - 1
            high[alive[~symbol_known]] = low[alive[~symbol_known]]
            alive, symbol = alive[symbol_known], symbol[symbol_known]
            low[alive] = self.before[symbol] + self.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back to a sampled position and count the steps."""
        out, at, open_ = np.empty(len(rows), dtype=np.int64), rows.copy(), np.arange(len(rows))
        for steps in range(self.sample):
            here = at[open_]
            marked = self.marks[here + 1] > self.marks[here]
            out[open_[marked]] = self.positions[self.marks[here[marked]]] + steps
            open_ = open_[~marked]
            at[open_] = self.back(at[open_])
        return out


def search_shard(texts: list[bytes], phrases: Phrases) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per text: its number of words, merged hit spans (word numbers) and item ids."""
    runs: dict[bytes, int] = {}
    starts: list[int] = []
    symbols: list[np.ndarray] = []
    size = 0
    uses: list[list[tuple[int, int]]] = []
    counts: list[int] = []
    separator = np.ones(1, dtype=np.int64)
    for text in texts:
        words = words_of(text)
        get = phrases.symbol.get
        ids = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
        known = np.flatnonzero(np.diff(np.r_[0, ids > 0, 0]))
        used = []
        for start, end in known.reshape(-1, 2):
            if phrases.shortest and end - start >= phrases.shortest:
                run = ids[start:end]
                number = runs.setdefault(run.tobytes(), len(starts))
                if number == len(starts):
                    starts.append(size)
                    symbols += [run, separator]
                    size += len(run) + 1
                used.append((int(start), number))
        uses.append(used)
        counts.append(len(words))
    hits: dict[int, list[tuple[int, int]]] = {}
    named: dict[int, set[str]] = {}
    if starts:
        index = ShardIndex(np.concatenate([*symbols, np.zeros(1, dtype=np.int64)]))
        low, high = index.search(phrases.windows, phrases.lengths)
        found = np.repeat(np.arange(len(low)), high - low)
        first = np.repeat(np.cumsum(high - low) - (high - low), high - low)
        at = index.locate(np.arange(len(found)) - first + low[found])
        begin = np.array(starts)
        run_of = np.searchsorted(begin, at, side="right") - 1
        for k in np.lexsort((at, run_of)):
            run, start = int(run_of[k]), int(at[k] - begin[run_of[k]])
            end = start + int(phrases.lengths[found[k]])
            spans = hits.setdefault(run, [])
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
            else:
                spans.append((start, end))
            named.setdefault(run, set()).update(phrases.items[found[k]])
    for count, used in zip(counts, uses, strict=True):
        spans = [(start + a, start + b) for start, run in used for a, b in hits.get(run, ())]
        yield count, spans, sorted(set().union(*(named.get(run, ()) for _, run in used)))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def phrase_blocks(benchmark: DataFrame, width: int, block_bytes: int) -> Iterator[Phrases]:
    """The benchmark's phrases in blocks of about ``block_bytes`` of text."""
    texts = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    texts = texts.filter(F.length("text") > 0)
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        part = texts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield Phrases([(r["item"], bytes(r["text"])) for r in part.toLocalIterator()], width)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, n_words, spans (merged, in words, end exclusive) and items (sorted ids as strings)."""
    context = docs.sparkSession.sparkContext
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def search(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            texts = utf8(part.column("text"))
            counts, spans, items = [], [], []
            before = zip(part.column("spans").to_pylist(), part.column("items").to_pylist())
            for (n, hit, names), (spans_before, items_before) in zip(search_shard(texts, shared.value), before):
                counts.append(n)
                spans.append([{"start": a, "end": b} for a, b in merged(hit + [(s["start"], s["end"]) for s in spans_before])])
                items.append(sorted({*names, *items_before}))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("text"), pa.array(counts, pa.int64()),
                    pa.array(spans, spans_type), pa.array(items, pa.list_(pa.string())),
                ],
                names=["doc_id", "text", "n_words", "spans", "items"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    schema = f"doc_id long, text string, {FOUND.partition(', ')[2]}"
    shared = None
    for phrases in phrase_blocks(benchmark, width, block_bytes):
        if shared is not None:
            rows = settle(rows, "hits")
            shared.unpersist()
        shared = context.broadcast(phrases)
        rows = rows.mapInArrow(partial(search, shared), schema)
    return rows.drop("text")


def digest(found: DataFrame) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def without_contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, all columns as they are; no shuffle."""
    context = docs.sparkSession.sparkContext

    def keep(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            clean = [not hit for _, hit, _ in search_shard(utf8(part.column("text")), shared.value)]
            yield part.filter(pa.array(clean, pa.bool_()))

    rows, shared = docs, None
    for phrases in phrase_blocks(benchmark, width, block_bytes):
        if shared is not None:
            rows = settle(rows, "clean")
            shared.unpersist()
        shared = context.broadcast(phrases)
        rows = rows.mapInArrow(partial(keep, shared), docs.schema)
    return rows
