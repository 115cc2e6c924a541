"""SimHash near-duplicates: fingerprints, links at few differing bits, components.

Exact copies share a fingerprint and are one class from then on. Pairs of classes are compared
by pivot distance tables: each fingerprint's Hamming distances to ``PIVOTS`` references are
computed once, a pair whose distances to any reference differ by more than the limit is
discarded, and the survivors are verified. A table of distances alone would have to be compared
with every other one, so bit ranges deal the pairs to tasks: of ``r`` ranges of the 64 bits, a
pair within ``d`` bits agrees in at least ``r - d``, so it meets in the bucket of these ranges.

A bucket beyond ``BUCKET`` fingerprints is not compared pair by pair. Its fingerprints are linked
exactly through all fingerprints within half the distance of them: two that share one are within
the distance, and two within the distance share one.

Rows: texts without words have fingerprint zero, null texts too; repeated rows are handled one by
one; rows without ``doc_id`` link like others, but never name a component unless it has no id at
all; empty input gives empty output; columns besides ``doc_id`` and ``text`` are not looked at.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.components import components
from fareflow.llm.texts import pieces, utf8
from fareflow.workspace import settle

SHINGLE = 4
DISTANCE = 4
SEED = 42
PIVOTS = 24
BUCKET = 20_000
#: Up to this many fingerprints in a bucket, all pairs of neighbours are compared at once.
SMALL = 64
CHUNK = 1 << 15


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """64 bits, each set if more than half of the shingles' hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1 :]
    digest, sums = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, n, CHUNK):
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts[k : min(n, k + CHUNK)].tolist(), last[k : k + CHUNK].tolist())]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint, as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            marks = np.array([fingerprint(t, width) for t in utf8(part.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(marks.view(np.int64))], names=["doc_id", "fingerprint"]
            )

    return docs.select("doc_id", "text").mapInArrow(hashed, "doc_id long, fingerprint long")


def near_one(marks: np.ndarray, table: np.ndarray, at: int, left: np.ndarray, distance: int) -> np.ndarray:
    """Which of the fingerprints numbered ``left`` are within the distance of number ``at``."""
    kept = np.flatnonzero((np.abs(table[left] - table[at]) <= distance).all(axis=1))
    return kept[np.bitwise_count(marks[left[kept]] ^ marks[at]) <= distance]


def bit_ranges(n: int, distance: int) -> list[int]:
    """Masks of the bit ranges in which a bucket's fingerprints agree.

    More ranges make more, finer buckets: the number of bits is chosen to be near the logarithm
    of the number of fingerprints, so that buckets stay small as the corpus grows.
    """
    ranges = distance + 2
    while ranges < 16 and 64 * (ranges - distance) // ranges < np.log2(max(2, n)):
        ranges += 1
    edges = [64 * k // ranges for k in range(ranges + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, ranges - distance)]


def pivots(number: int) -> np.ndarray:
    """Reference fingerprints: fixed, spread over the space by their hash."""
    return np.array([xxhash.xxh64_intdigest(b"pivot", k) for k in range(number)], dtype=np.uint64)


def distance_table(marks: np.ndarray, references: np.ndarray) -> np.ndarray:
    return np.bitwise_count(marks[:, None] ^ references[None, :]).astype(np.int8)


def verified(a: np.ndarray, b: np.ndarray, ta: np.ndarray, tb: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs are within the distance: first by the tables, then by the fingerprints."""
    kept = np.flatnonzero((np.abs(ta - tb) <= distance).all(axis=-1))
    return kept[np.bitwise_count(a[kept] ^ b[kept]) <= distance]


def links_in(keys: np.ndarray, marks: np.ndarray, references: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among fingerprints of equal key; the arrays are sorted by key.

    Of larger buckets only as many links as connect them come out.
    """
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[first, len(keys)])
    table = distance_table(marks, references)
    small = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL), sizes))
    for lag in range(1, SMALL):
        small = small[small + lag < len(keys)]
        small = small[keys[small] == keys[small + lag]]
        if not len(small):
            break
        near = small[verified(marks[small], marks[small + lag], table[small], table[small + lag], distance)]
        yield marks[near], marks[near + lag]
    for k in np.flatnonzero(sizes > SMALL):
        left = np.arange(first[k], first[k] + sizes[k])
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                at = queue.pop()
                near = near_one(marks, table, at, left, distance)
                if len(near):
                    found = left[near]
                    yield np.full(len(found), marks[at]), marks[found]
                    queue += found.tolist()
                    left = np.delete(left, near)


def linked(classes: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that connect all those within the distance.

    ``classes`` has one row per fingerprint and is a written table.
    """
    masks = np.array(bit_ranges(classes.count(), distance), dtype=np.uint64)
    references = pivots(PIVOTS)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(0).to_numpy().view(np.uint64)
            for number, mask in enumerate(masks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(marks), number, dtype=np.int16)), pa.array((marks & mask).view(np.int64)), batch.column(0)],
                    names=["number", "bits", "fingerprint"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches come sorted by bucket; a bucket that a batch cuts is carried to the next."""
        names = ["a", "b", "crowded"]

        def out(a: np.ndarray, b: np.ndarray, crowded: bool) -> pa.RecordBatch:
            flags = pa.array(np.full(len(a), crowded))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), flags], names=names)

        def whole(numbers: np.ndarray, bits: np.ndarray, marks: np.ndarray) -> Iterator[pa.RecordBatch]:
            change = np.r_[True, (numbers[1:] != numbers[:-1]) | (bits[1:] != bits[:-1])]
            for a, b in links_in(np.cumsum(change), marks, references, distance):
                if len(a):
                    yield out(a, b, False)

        held: tuple[np.ndarray, ...] | None = None
        full: tuple[int, int] | None = None
        for batch in batches:
            now = tuple(batch.column(k).to_numpy() for k in range(3))
            now = (now[0], now[1], now[2].view(np.uint64))
            if not len(now[0]):
                continue
            if full is not None:
                same = (now[0] == full[0]) & (now[1] == full[1])
                if same.any():
                    yield out(now[2][same], now[2][same], True)
                now = tuple(x[~same] for x in now)
                if not len(now[0]):
                    continue
                full = None
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now))
            tail = int(np.argmax((now[0] == now[0][-1]) & (now[1] == now[1][-1])))
            sizes = len(now[0]) - tail
            yield from whole(*(x[:tail] for x in now)) if tail else ()
            held = tuple(x[tail:] for x in now)
            if sizes > bucket:
                yield out(held[2], held[2], True)
                full, held = (held[0][-1], held[1][-1]), None
        if held is not None:
            yield from whole(*held)

    buckets = classes.select("fingerprint").mapInArrow(keyed, "number short, bits long, fingerprint long")
    dealt = buckets.repartition("number", "bits").sortWithinPartitions("number", "bits")
    pairs = settle(dealt.mapInArrow(compare, "a long, b long, crowded boolean"), "links")
    crowded = pairs.filter("crowded").select(F.col("a").alias("fingerprint")).distinct()
    return pairs.filter("not crowded").select("a", "b").union(linked_by_middle(crowded, distance))


def linked_by_middle(classes: DataFrame, distance: int) -> DataFrame:
    """Connect fingerprints within the distance through the fingerprints halfway between them.

    Each row becomes a fixed number of rows; the smallest fingerprint of each middle is found
    with map-side partials, so no middle's fingerprints come together.
    """
    half = distance // 2
    flips = np.array(
        [sum(1 << b for b in bits) for size in range(half + 1) for bits in combinations(range(64), size)], dtype=np.uint64
    )

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(0).to_numpy().view(np.uint64)
            for mark in marks:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(flips), mark).view(np.int64)), pa.array((flips ^ mark).view(np.int64))],
                    names=["fingerprint", "middle"],
                )

    near = classes.mapInArrow(around, "fingerprint long, middle long")
    least = near.groupBy("middle").agg(F.min("fingerprint").alias("a"))
    pairs = near.join(least, "middle").filter("a < fingerprint")
    return pairs.select("a", F.col("fingerprint").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint, root (the fingerprint that stands for the component) and component_id.

    One row per row of ``docs``.

    Only linked classes join the table of components; a hot fingerprint is reduced to one row
    before any join, and the last join is one that adaptive execution splits by skew.
    """
    if distance % 2:
        raise ValueError("the distance must be even: crowded buckets are linked through halfway fingerprints")
    marked = settle(fingerprints(docs, width), "fingerprints")
    classes = settle(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    roots = settle(components(linked(classes, distance, bucket)), "roots")
    named = classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = named.withColumn("root", F.coalesce("root", "fingerprint"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settle(named.join(least, "root").select("fingerprint", "root", "component_id"), "components")
    return marked.join(named, "fingerprint").select("doc_id", "fingerprint", "root", "component_id")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The row of ``docs`` with the smallest id of each component, columns unchanged.

    The ids that stay grow with the corpus, so the join with them is a shuffle at every size, with
    one id per build row and the texts streamed. Only the rows of an id that names a component and
    occurs more than once are told apart by a hash of their text, of which the smallest stays.
    """
    rows = settle(near_duplicates(docs, width, distance), "near")
    first = rows.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    ids = settle(first.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n")), "first")
    single = ids.filter("n = 1").hint("shuffle_hash")
    kept = docs.join(single, docs["doc_id"].eqNullSafe(single["id"]), "left_semi")
    repeated = ids.filter("n > 1").withColumnRenamed("id", "of")
    if repeated.isEmpty():
        return kept
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    told = docs.select(row, docs["doc_id"].alias("id"), docs["text"].alias("words"), F.xxhash64(docs["text"]).alias("text_hash"))
    told = told.join(repeated, told["id"].eqNullSafe(repeated["of"]), "left_semi")
    marked = fingerprints(told.select(F.col("text_hash").alias("doc_id"), F.col("words").alias("text")), width)
    marks = marked.select(F.col("doc_id").alias("text_hash"), "fingerprint").distinct()
    roots = rows.select("fingerprint", F.col("root").alias("root")).distinct()
    told = told.join(marks, "text_hash").join(roots, "fingerprint")
    least = told.groupBy(F.col("id").alias("of"), F.col("root").alias("in_root")).agg(F.min("text_hash").alias("least"))
    winners = told.join(
        least,
        told["id"].eqNullSafe(least["of"]) & (told["root"] == least["in_root"]) & (told["text_hash"] == least["least"]),
        "left_semi",
    )
    return kept.union(winners.dropDuplicates(["id", "root"]).select("row.*"))
