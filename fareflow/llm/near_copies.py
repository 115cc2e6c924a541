"""Near-duplicate documents by SimHash candidates that are verified on whole texts.

1. Texts of the same words are one class. Each class has a SimHash fingerprint of its five-word
   shingles; two texts of similarity 0.8 differ in some ten of its 64 bits.
2. Fingerprints meet in buckets, those that agree in a chosen set of bits; there are as many sets as give
   a pair at ``AIM`` bits a chance of ``FOUND`` to meet, and they have more bits as there are more fingerprints, so
   that buckets stay small. In a bucket tables of distances to pivots discard pairs, and the
   rest within ``DISTANCE`` bits are candidates, of which each fingerprint keeps two over all buckets: the
   nearest and the smallest. So there are no more than two candidates per fingerprint, however large its group.
3. A sketch of a class counts its distinct shingles by ``CELLS`` cells. The sum of the smaller counts of
   two classes is at least the number of shingles they share, so pairs for which it is too small are no
   links; their sets are not looked at, and in buckets such pairs are never made.
   The others are compared by the sets of their shingles, of whole texts; those of a similarity of 0.8
   or more are links, and groups are what links connect.
4. Where there were more candidates than were kept, more fingerprints than are compared at once, or several
   classes of one fingerprint, all their pairs that are not in one group by now are compared too.

Rows: null texts and texts without words are one class; texts of fewer than five words have their
sequence of words as only shingle; very long texts are handled whole, one at a time; repeated rows and
ids belong to their texts' groups; empty input gives empty output; other columns are not looked at.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.components import components
from fareflow.llm.simhash import PIVOTS, fingerprint, links_in, pivots
from fareflow.llm.texts import pieces, utf8
from fareflow.workspace import settle

WIDTH, SIMILAR = 5, 0.8
#: Bits of the table that says which texts have candidates (it only saves work).
TABLE_BITS = 27
DISTANCE = 13
#: The number of bit sets is such that a pair that differs in ``AIM`` bits meets with a chance of ``FOUND``.
AIM, FOUND = 10, 0.97
#: A bucket has 2^-SPARE of a fingerprint's share, on average 2^SPARE fingerprints.
SPARE = 3
#: Fingerprints of a bucket that are compared at once; later ones meet the first of the bucket too, and all others later.
BUCKET = 20_000
#: Classes of a bucket that are compared at once with as many others.
PART = 2048
#: Tasks that the partners of one class are dealt to.
SALTS = 16
#: Times that each class is compared with few others before all pairs that are not in one group by then are.
ROUNDS = 2
#: Cells of a sketch, one byte each; a full one stands for any count from there on.
CELLS, FULL = 128, 255


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def text_class(words: list[bytes]) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(b" ".join(words))).view(np.int64))


def shingle_set(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Sorted 31-bit hashes of the distinct shingles."""
    if not words:
        return np.zeros(0, dtype=np.int32)
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.array([digest(b" ".join(words[k : k + width])) >> 33 for k in range(n)], dtype=np.int32))


def sketch(shingles: np.ndarray) -> bytes:
    """How many of the shingles are in each cell."""
    return np.minimum(np.bincount(shingles & (CELLS - 1), minlength=CELLS), FULL).astype(np.uint8).tobytes()


def cells_of(column: pa.Array) -> np.ndarray:
    """Sketches as rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, CELLS)


def able(sizes: tuple[np.ndarray, np.ndarray], cells: tuple[np.ndarray, np.ndarray], similar: float) -> np.ndarray:
    """Which pairs of classes can be links by their numbers of shingles and sketches; no link is left out."""
    least, most = np.minimum(*sizes), np.maximum(*sizes)
    out = least >= similar * most
    some = np.flatnonzero(out)
    a, b = cells[0][some], cells[1][some]
    common = np.minimum(a, b).sum(axis=1, dtype=np.int64)
    enough = common >= similar * (least[some] + most[some] - common)
    out[some] = enough | ((a == FULL) & (b == FULL)).any(axis=1)
    return out


def few_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (a < b) of some buckets, for each end the nearest and the smallest other end.

    Near copies in a bucket are linked to nearly all others there; few links of each do to connect most of them.
    """
    own, other = np.r_[a, b], np.r_[b, a]
    some = first_of_each(own, (np.lexsort((other, own)), np.lexsort((other, np.bitwise_count(own ^ other), own))))
    return a[some], b[some]


def first_of_each(own: np.ndarray, orders: tuple[np.ndarray, ...]) -> np.ndarray:
    """Numbers of the pairs that come first for an end in one of the orders; ``own`` has the one ends of all, then the others."""
    firsts = [order[np.r_[True, own[order][1:] != own[order][:-1]]] for order in orders]
    return np.unique(np.concatenate(firsts) % (len(own) // 2))


def classes_of(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key (of the text as it is), class (of its words), fingerprint, shingles and sketch of every row."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[int, int, bytes]] = {}
        for part in pieces(batches):
            refs, found = [], []
            for text in utf8(part.column("text")):
                words = words_of(text)
                ref = text_class(words)
                if ref not in known:
                    if len(known) > 50_000:
                        known.clear()
                    own = shingle_set(words, width)
                    known[ref] = fingerprint(text, width), len(own), sketch(own)
                refs.append(ref)
                found.append(known[ref])
            marks, sizes, sketches = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("text_key"), pa.array(refs, pa.int64()),
                 pa.array(np.array(marks, dtype=np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary())],
                names=["doc_id", "text_key", "ref", "fingerprint", "size", "sketch"],
            )

    rows = docs.select("doc_id", "text", text_key().alias("text_key"))
    return rows.mapInArrow(marked, "doc_id long, text_key long, ref long, fingerprint long, size int, sketch binary")


def text_key():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def bit_sets(n: int) -> np.ndarray:
    """Masks of the chosen bits, from a fixed seed."""
    bits = min(40, max(4, math.ceil(math.log2(max(2, n))) - SPARE))
    together = math.comb(64 - AIM, bits) / math.comb(64, bits)
    number = math.ceil(math.log(1 - FOUND) / math.log(1 - together))
    rng = np.random.default_rng(64)
    return np.array([sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in range(number)], dtype=np.uint64)


def candidates(marks: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within the distance that met in a bucket, some of many.

    ``alone`` are those that no other pair of their bucket stands beside. Rows with ``bucket`` and without ``b``
    are the fingerprints of buckets that may have had more pairs.
    """
    masks, references = bit_sets(marks.count()), pivots(PIVOTS)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            for number, mask in enumerate(masks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), number, dtype=np.int16)), pa.array((own & mask).view(np.int64)), batch.column(0)],
                    names=["number", "bits", "fingerprint"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches come sorted by bucket; a bucket that a batch cuts is carried to the next, or its first one is."""

        def found(now: tuple[np.ndarray, ...], cut: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
            number, bits, own = now
            keys = np.cumsum(np.r_[True, (number[1:] != number[:-1]) | (bits[1:] != bits[:-1])]) - 1
            parts = [(a, b) for a, b in links_in(keys, own, references, distance) if len(a)]
            held = np.zeros(len(own), dtype=bool) if cut is None else (number == cut[0]) & (bits == cut[1])
            if parts:
                a, b = (np.concatenate(x) for x in zip(*parts))
                met = np.isin(own, np.union1d(a, b))
                several = (np.bincount(keys[met], minlength=keys[-1] + 1) > 2)[keys]
                held |= met & several
                two = own[met & ~several & (np.bincount(keys[met], minlength=keys[-1] + 1) == 2)[keys]].reshape(-1, 2)
                two = two[np.bitwise_count(two[:, 0] ^ two[:, 1]) <= distance]
                yield batch_of(two.min(axis=1), two.max(axis=1), None, True)
                yield batch_of(*few_links(np.minimum(a, b), np.maximum(a, b)), None, False)
            if held.any():
                with np.errstate(over="ignore"):
                    bucket = (bits[held] * np.int64(-7046029254386353131)) ^ number[held]
                yield batch_of(own[held], None, bucket, False)

        def batch_of(a: np.ndarray, b: np.ndarray | None, bucket: np.ndarray | None, alone: bool) -> pa.RecordBatch:
            columns = [pa.nulls(len(a), pa.int64()) if c is None else pa.array(c.view(np.int64)) for c in (a, b, bucket)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(a), alone))], names=["a", "b", "bucket", "alone"])

        held: tuple[np.ndarray, ...] | None = None
        cut: tuple[int, int] | None = None
        for batch in batches:
            now = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64))
            if not len(now[0]):
                continue
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now))
            tail = int(np.argmax((now[0] == now[0][-1]) & (now[1] == now[1][-1])))
            if len(now[0]) - tail > bucket:
                before, cut = cut, (int(now[0][-1]), int(now[1][-1]))
                if before not in (None, cut):
                    yield from found(tuple(x[:tail] for x in now), before)
                    now, tail = tuple(x[tail:] for x in now), 0
                tail = len(now[0])
            if tail:
                yield from found(tuple(x[:tail] for x in now), cut)
            rest = tuple(x[tail:] for x in now)
            if tail == len(now[0]):
                first = int(np.argmax((now[0] == now[0][-1]) & (now[1] == now[1][-1])))
                rest = tuple(x[first : first + 1] for x in now)
            held = rest
        if held is not None:
            yield from found(held, cut)

    buckets = marks.select("fingerprint").mapInArrow(keyed, "number short, bits long, fingerprint long")
    dealt = buckets.repartition("number", "bits").sortWithinPartitions("number", "bits", "fingerprint")
    return dealt.mapInArrow(compare, "a long, b long, bucket long, alone boolean").distinct()


def kept_pairs(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the candidates, for each fingerprint the pairs with the nearest and the smallest other, and those left that are alone."""
    pairs = met.filter("b is not null").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("alone").alias("alone"))
    ends = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    best = ends.groupBy("a").agg(F.array(F.min("b"), F.min(F.struct(far.alias("far"), "b"))["b"]).alias("others"))
    ends = best.select("a", F.explode("others").alias("b"))
    kept = settle(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "kept-pairs")
    both = pairs.filter("alone").select("a", "b", F.lit(False).alias("kept")).union(kept.withColumn("kept", F.lit(True)))
    marked = both.groupBy("a", "b").agg(F.max("kept").alias("kept"))
    return kept, marked.filter("not kept").select("a", "b")


def class_pairs(marked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (a, b) of classes to verify: the first ones of two fingerprints, and those of one with its first.

    And the classes, and (bucket, fingerprint) of all that may have more pairs.
    """
    classes = settle(marked.select("ref", "fingerprint", "size", "sketch").dropDuplicates(["ref"]), "classes")
    firsts = settle(classes.groupBy("fingerprint").agg(F.min("ref").alias("first")), "firsts")
    met = settle(candidates(firsts), "near")
    near, beside = kept_pairs(met)
    left = firsts.select(F.col("fingerprint").alias("a"), F.col("first").alias("x"))
    right = firsts.select(F.col("fingerprint").alias("b"), F.col("first").alias("y"))
    between = near.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    same = classes.join(firsts, "fingerprint").filter("ref <> first").select(F.col("first").alias("a"), F.col("ref").alias("b"))
    several = classes.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("fingerprint").alias("of"))
    both = near.withColumn("ends", F.array("a", "b")).withColumn("of", F.explode("ends")).join(several, "of", "left_semi")
    both = both.select("a", "b", "ends").union(beside.withColumn("ends", F.array("a", "b")))
    ends = both.select(F.xxhash64("a", "b").alias("bucket"), F.explode("ends").alias("fingerprint"))
    own = several.select(F.xxhash64("of").alias("bucket"), F.col("of").alias("fingerprint"))
    open_ = met.filter("b is null").select("bucket", F.col("a").alias("fingerprint")).union(ends).union(own)
    return settle(between.union(same).distinct(), "pairs"), classes, settle(open_.distinct(), "open")


def possible(pairs: DataFrame, classes: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) that can be links by their sketches."""
    first, second = (classes.select(F.col("ref").alias(c), F.struct("size", "sketch").alias(f"of_{c}")) for c in "ab")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(c) for c in ("of_a", "of_b")]
            sizes, cells = zip(*((x.field("size").to_numpy(), cells_of(x.field("sketch"))) for x in sides))
            yield batch.select(["a", "b"]).filter(pa.array(able(sizes, cells, similar)))

    return settle(pairs.join(first, "a").join(second, "b").mapInArrow(look, "a long, b long"), "possible")


def most_alike(a: np.ndarray, b: np.ndarray, alike: np.ndarray, root_a: np.ndarray, root_b: np.ndarray) -> np.ndarray:
    """Of the pairs (a, b) for each end the most alike one and one with the other group of the smallest root."""
    own, other, root = np.r_[a, b], np.r_[b, a], np.r_[root_b, root_a]
    return first_of_each(own, (np.lexsort((-other, -np.r_[alike, alike], own)), np.lexsort((other, root, own))))


def pairs_left(
    open_: DataFrame, classes: DataFrame, roots: DataFrame, done: DataFrame, distance: int = DISTANCE, part_rows: int = PART, similar: float = SIMILAR,
    few: bool = False,
) -> DataFrame:
    """Pairs (a, b) of classes of a bucket within the distance that are in two groups, can be links and were not compared.

    A bucket of many classes is dealt in parts, each of which meets each. With ``few`` each class chooses two of its
    pairs, the most alike by the sketches and one with the group of the smallest root.
    """
    grouped = classes.select("ref", "fingerprint").join(roots, "ref", "left").withColumn("root", F.coalesce("root", "ref"))
    members = open_.join(grouped, "fingerprint")
    sizes = members.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    apart = settle(sizes.filter("low <> high").select("bucket", F.ceil(F.col("n") / part_rows).alias("parts")), "apart")
    own = F.pmod(F.xxhash64("ref"), F.col("parts"))
    parts = members.join(apart, "bucket").withColumn("part", own)
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda k: F.xxhash64(F.least(k, "part"), F.greatest(k, "part")))
    sketched = parts.join(classes.select("ref", "size", "sketch"), "ref")
    dealt = sketched.withColumn("deal", F.explode(others)).select("bucket", "deal", "ref", "fingerprint", "root", "size", "sketch")

    names = ["a", "b", "alike", "root_a", "root_b"]

    def near(now: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, _, ref, marks, root, size, cells = now
        marks = marks.view(np.uint64)
        best = (np.zeros(0, dtype=np.int64),) * 5
        for begin in range(0, len(ref), 512):
            block = slice(begin, begin + 512)
            hit = (np.bitwise_count(marks[block, None] ^ marks) <= distance) & (root[block, None] != root)
            x, y = np.nonzero(hit)
            x += begin
            first = np.flatnonzero(ref[x] < ref[y])
            for some in (first[k : k + 50_000] for k in range(0, len(first), 50_000)):
                some = some[able((size[x[some]], size[y[some]]), (cells[x[some]], cells[y[some]]), similar)]
                i, j = x[some], y[some]
                common = np.minimum(cells[i], cells[j]).sum(axis=1, dtype=np.int64)
                alike = common * 1_000_000 // np.maximum(1, size[i].astype(np.int64) + size[j] - common)
                found = ref[i], ref[j], alike, root[i], root[j]
                if few and len(some):
                    best = tuple(np.concatenate(c) for c in zip(best, found))
                    chosen = most_alike(*best)
                    best = tuple(c[chosen] for c in best)
                elif not few:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=names)
        if len(best[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in best], names=names)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [*(c.to_numpy() for c in batch.columns[:-1]), cells_of(batch.columns[-1])]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            start = np.flatnonzero(np.r_[True, (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])])
            for low, high in zip(start[:-1], start[1:]):
                yield from near([x[low:high] for x in now])
            held = [x[start[-1] :] for x in now]
        if held is not None:
            yield from near(held)

    sorted_ = dealt.repartition("bucket", "deal").sortWithinPartitions("bucket", "deal")
    met = sorted_.mapInArrow(compared, "a long, b long, alike long, root_a long, root_b long")
    if few:
        turned = met.select(F.col("b").alias("a"), F.col("a").alias("b"), "alike", F.col("root_b").alias("root_a"), F.col("root_a").alias("root_b"))
        best = met.union(turned).groupBy("a").agg(F.array(F.max(F.struct("alike", "b"))["b"], F.min(F.struct("root_b", "b"))["b"]).alias("others"))
        met = best.select("a", F.explode("others").alias("b"))
    found = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    known = done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return settle(found.join(known, ["a", "b"], "left_anti"), "pairs-left")


def asked_table(keys: DataFrame) -> np.ndarray:
    """A bit per cell of the text keys that are asked for; its size does not depend on the data."""
    place = F.shiftrightunsigned("text_key", 64 - TABLE_BITS)
    cells = keys.select(F.shiftright(place, 6).alias("cell"), (place % 64).cast("int").alias("at"))
    rows = cells.groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits")).toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), dtype=np.uint64)
    table[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return table


def shingle_sets(docs: DataFrame, marked: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """ref and shingles of the classes that are in a pair, from one text of each.

    No text is shuffled: a bit table tells the tasks which to look at, a few too many.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("ref")).distinct()
    one = marked.groupBy("ref").agg(F.min("text_key").alias("text_key")).join(wanted, "ref", "left_semi")
    keys = settle(one, "wanted")
    shared = docs.sparkSession.sparkContext.broadcast(asked_table(keys))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in pieces(batches):
            own = part.column("text_key").to_numpy()
            place = own.view(np.uint64) >> np.uint64(64 - TABLE_BITS)
            hit = shared.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)
            some = [k for k in np.flatnonzero(hit).tolist() if int(own[k]) not in seen]
            some = list({int(own[k]): k for k in some}.values())
            seen.update(own[some].tolist())
            texts = utf8(part.column("text").take(pa.array(some, pa.int64())))
            sets = [shingle_set(words_of(t), width) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(own[some]), pa.array(sets, pa.list_(pa.int32()))], names=["text_key", "shingles"])

    found = docs.select("text", text_key().alias("text_key")).mapInArrow(made, "text_key long, shingles array<int>")
    return found.join(keys, "text_key").select("ref", "shingles").dropDuplicates(["ref"])


def verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Those of the pairs (a, b) whose shingle sets are similar enough.

    The set of a class comes once to each task that has partners of it, and stays there while they pass.
    """
    salt = F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")
    dealt = pairs.withColumn("salt", salt)
    sets = settle(sets, "sets")
    none = F.lit(None).cast("long")
    heads = dealt.select("a", "salt").distinct().join(sets, F.col("a") == F.col("ref")).select("a", "salt", none.alias("b"), "shingles")
    partners = dealt.join(sets, F.col("b") == F.col("ref")).select("a", "salt", "b", "shingles")
    both = heads.union(partners).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_set = None, np.zeros(0, dtype=np.int32)
        for batch in batches:
            a, b = [], []
            lists = batch.column("shingles")
            values, ends = lists.flatten().to_numpy(), np.cumsum(np.diff(lists.offsets.to_numpy()))
            for k, (first, second) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                own = values[(ends[k - 1] if k else 0) : ends[k]]
                if second is None:
                    head, head_set = first, own.copy()
                elif head == first:
                    at = np.minimum(np.searchsorted(head_set, own), max(len(head_set) - 1, 0))
                    common = int((head_set[at] == own).sum()) if len(head_set) else 0
                    if common >= similar * (len(own) + len(head_set) - common):
                        a.append(first)
                        b.append(second)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return both.mapInArrow(check, "a long, b long").distinct()


def near_copies(docs: DataFrame, width: int = WIDTH, similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_key, ref) and the groups (ref, root) of classes that have links."""
    marked = settle(classes_of(docs, width), "marked")
    pairs, classes, open_ = class_pairs(marked)
    some = possible(pairs, classes, similar)
    links = settle(verified(some, shingle_sets(docs, marked, some, width), similar), "verified")
    roots = settle(components(links).select(F.col("node").alias("ref"), "root"), "roots")
    done = pairs
    for few in (True,) * ROUNDS + (False,):
        more = pairs_left(open_, classes, roots, done, similar=similar, few=few)
        if more.isEmpty():
            continue
        done = done.union(more)
        links = links.union(settle(verified(more, shingle_sets(docs, marked, more, width), similar), "verified"))
        roots = settle(components(links).select(F.col("node").alias("ref"), "root"), "roots")
    return marked, roots


def one_of_each(docs: DataFrame, width: int = WIDTH, similar: float = SIMILAR) -> DataFrame:
    """The row of ``docs`` with the smallest id of each group, columns unchanged.

    Rows without id stay only where their group has none with one; of rows that share the id or have
    none the smallest text hash stays, and one of rows that share that too. The ids that stay grow
    with the corpus, so the join with them is a shuffle at every size, with small build rows and the texts streamed.
    """
    marked, roots = near_copies(docs, width, similar)
    named = marked.join(roots, "ref", "left").withColumn("root", F.coalesce("root", "ref"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_key").alias("key")))
    kept = settle(named.groupBy("root").agg(best.alias("best")).select("best.id", "best.key"), "kept")
    copies = marked.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(F.count("*").alias("n"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    keyed = docs.select(row, docs["doc_id"].alias("of"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("of_key"))
    chosen = keyed.join(kept.hint("shuffle_hash"), keyed["of"].eqNullSafe(kept["id"]) & (keyed["of_key"] == kept["key"]), "left_semi")
    many = settle(copies.filter("n > 1").select(F.col("id").alias("many_id"), F.col("key").alias("many_key")), "many")
    if many.isEmpty():
        return chosen.select("row.*")
    again = chosen["of"].eqNullSafe(many["many_id"]) & (chosen["of_key"] == many["many_key"])
    single = chosen.join(many, again, "left_anti").select("row")
    first = chosen.join(many, again, "left_semi").dropDuplicates(["of", "of_key"]).select("row")
    return single.union(first).select("row.*")
