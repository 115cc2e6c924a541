"""Align two tokenizers' tokens of the same text by products of sparse token-byte matrices.

A matrix of tokens by bytes has a 1 where a token covers a byte; it is kept as CSR (row pointers,
column indices) built from the token lengths. Row products of A with the transposed B (Gustavson: the
rows of the right matrix that a left row names are merged) give the tokens that overlap, with the
number of bytes they share. Where tokens of both end at the same byte a group ends; matrices of
tokens by groups, A times transposed B, link all tokens of a group. The texts of a batch
are one block-diagonal matrix, so a product is a few array operations for all of them.

Texts are encoded by their words: a single space between two characters that show is always the begin of a
token if no token of the vocabulary has such a space inside, so the stretches between such spaces have the
same tokens wherever they occur. A worker encodes each once, new ones together in lines, and cuts the lines' tokens
at the ends of the stretches; a line that cannot be cut there is encoded stretch by stretch.

Per document the links are reduced to distinct id pairs with their times, and written. Spark counts in
how many documents a pair occurs; the commonest pairs, at most ``COMMON`` whatever the corpus, go to
all tasks as sorted arrays, the rarer ones are joined. Both ways give the same sums.

Rows: null and empty texts, and texts whose tokens do not spell the text again, have no tokens and
count zero everywhere; very long texts are handled whole, one at a time; every row is a
document, also if it repeats an id or a text; ties in a token's commonest partner count for all of
them; empty input gives empty output. Columns besides ``doc_id`` and ``text`` are not looked at.
"""

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fareflow.llm.texts import pieces
from fareflow.workspace import settle

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
FILE_BYTES = 32 << 20
#: Bytes of text in one block-diagonal matrix (a longer text is one of its own).
BLOCK = 1 << 20
#: Id pairs that are sent to all tasks, at most: 24 bytes each.
COMMON = 1 << 20
#: Links of a group product that are made at once.
LINKS = 1 << 20
#: The spaces at which a text is cut into stretches, and what no token may have inside for that.
CUT, INSIDE = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])"), re.compile(r"[!-~\w\ufffd] ")
#: A stretch that can stand in a line with others, and how many of them a line has.
SHOWS, LINE = re.compile(r"[!-~\w](.*[!-~\w])?", re.DOTALL), 256
#: Stretches, and tokens of them, that a worker remembers before it forgets them all.
STRETCHES, TOKENS = 200_000, 1 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary: bytes that print as
    themselves do so, the others take the letters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Coder:
    """A tokenizer: ``encode`` gives the ids of each text, with a space before it; ``spelled`` the bytes of each id."""

    def __init__(self, encode, spelled: list[bytes]):
        self.encode, self.spelled = encode, spelled
        self.lengths = np.array([len(b) for b in spelled], dtype=np.int64)
        #: The ids in decimal, followed by nothing, a comma, a bar or a semicolon.
        self.numbers = [tuple(f"{i}{end}" for i in range(len(spelled))) for end in ("", ",", "|", ";")]
        self.cuts = not any(INSIDE.search(b.decode(errors="replace")) for b in spelled)
        self.forget()

    def forget(self) -> None:
        """No stretch is known: number of each stretch, its ids from ``start[number]`` on, and if they spell it again."""
        self.known: dict[str, int] = {}
        self.ids, self.start, self.good = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=bool)

    def spell(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids))

    def learn(self, new: list[str]) -> None:
        """Encode stretches that are not known yet."""
        lined, single = [], []
        for word in new:
            (lined if SHOWS.fullmatch(word) else single).append(word)
        lines = [lined[k : k + LINE] for k in range(0, len(lined), LINE)]
        order, ids, counts, good = [], [], [], []
        for line, found in zip(lines, self.encode([" ".join(line) for line in lines])):
            found = list(found)
            ends = np.cumsum(self.lengths[found])
            stops = np.cumsum([len(w.encode()) + 1 for w in line])
            at = np.searchsorted(ends, stops)
            if self.spell(found) != b" " + " ".join(line).encode() or (ends[at] != stops).any():
                single += line
                continue
            order += line
            ids += found
            counts += np.diff(at + 1, prepend=0).tolist()
            good += [True] * len(line)
        for word, found in zip(single, self.encode(single)):
            found = list(found)
            order.append(word)
            ids += found
            counts.append(len(found))
            good.append(self.spell(found) == b" " + word.encode())
        self.known.update(zip(order, range(len(self.known), len(self.known) + len(order))))
        self.ids = np.concatenate((self.ids, np.array(ids, dtype=np.int32)))
        self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(counts, dtype=np.int64)))
        self.good = np.concatenate((self.good, np.array(good, dtype=bool)))

    def tokens(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts, which are given in stretches, the text of each id, and which texts they spell again."""
        if not self.cuts:
            texts = [[" ".join(t)] for t in texts]
        if len(self.known) > STRETCHES or len(self.ids) > TOKENS:
            self.forget()
        words = list(chain.from_iterable(texts))
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self.learn(new)
        number = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        good = np.ones(len(texts), dtype=bool)
        good[text[~self.good[number]]] = False
        times = np.diff(self.start)[number]
        before = np.cumsum(times) - times
        place = np.arange(times.sum()) + np.repeat(self.start[number] - before, times)
        return self.ids[place].astype(np.int64), np.repeat(text, times), good


def byte_level_coder(content: bytes) -> Coder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs as many tasks as there are cores
    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.encode_special_tokens = True
    letters = byte_letters()
    spelled = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in json.loads(content)["model"]["vocab"].items():
        spelled[i] = bytes(letters[c] for c in token)
    for i, token in tokenizer.get_added_tokens_decoder().items():
        spelled[i] = spelled[i] or token.content.encode()

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    return Coder(encode, spelled)


def piece_coder(content: bytes) -> Coder:
    """Its model puts the space before the text."""
    model = sentencepiece.SentencePieceProcessor(model_proto=content)

    def spell(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return Coder(lambda texts: model.encode(texts, num_threads=1), [spell(i) for i in range(model.vocab_size())])


def read_file(path: str) -> bytes:
    content = Path(path).read_bytes()
    if len(content) > FILE_BYTES:
        raise ValueError(f"{path} is larger than {FILE_BYTES} bytes")
    return content


_coders: dict[int, Coder] = {}


def coder(make, content: bytes) -> Coder:
    """A worker builds each tokenizer once."""
    key = hash((make.__name__, content))
    if key not in _coders:
        _coders[key] = make(content)
    return _coders[key]


@dataclass
class Rows:
    """A sparse matrix by rows: row r has the columns ``index[start[r]:start[r + 1]]``, all with value 1."""

    start: np.ndarray
    index: np.ndarray
    width: int

    def transposed(self) -> "Rows":
        order = np.argsort(self.index, kind="stable")
        row = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        start = np.r_[0, np.cumsum(np.bincount(self.index, minlength=self.width))]
        return Rows(start, row[order], len(self.start) - 1)


def product(a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the entries of a times b, by rows.

    For every entry (r, k) of ``a`` the columns of row k of ``b`` are put in place of k; equal (r, column) are
    added up. They need sorting only where the rows of ``b`` do not come in order.
    """
    times = b.start[a.index + 1] - b.start[a.index]
    row = np.repeat(np.repeat(np.arange(len(a.start) - 1), np.diff(a.start)), times)
    before = np.cumsum(times) - times
    at = np.arange(len(row)) + np.repeat(b.start[a.index] - before, times)
    key = row * b.width + b.index[at]
    if len(key) and (key[1:] < key[:-1]).any():
        key = np.sort(key)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
    value = np.diff(np.r_[first, len(key)])
    row, column = np.divmod(key[first], max(b.width, 1))
    return row, column, value


def by_bytes(lengths: np.ndarray) -> Rows:
    """Tokens by bytes, for tokens that lie side by side."""
    start = np.r_[0, np.cumsum(lengths)]
    return Rows(start, np.arange(start[-1]), int(start[-1]))


def by_groups(group: np.ndarray, groups: int) -> Rows:
    """Tokens by groups: every token is in one."""
    return Rows(np.arange(len(group) + 1), group, groups)


@dataclass
class Aligned:
    """Texts side by side: ids of their tokens, and the text of each token; groups are numbered over all texts."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    text_of_group: np.ndarray
    links: tuple[np.ndarray, np.ndarray, np.ndarray]

    @property
    def groups(self) -> int:
        return len(self.text_of_group)

    def group_links(self, block: int = LINKS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All pairs of tokens in the same group, some rows of A at a time: row, column, 1."""
        a, b = by_groups(self.group_a, self.groups), by_groups(self.group_b, self.groups).transposed()
        ends = np.cumsum(np.diff(b.start)[a.index])
        begin = 0
        while begin < len(ends):
            before = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, before + block, side="right")))
            row, column, value = product(Rows(a.start[begin : stop + 1] - a.start[begin], a.index[begin:stop], a.width), b)
            yield row + begin, column, value
            begin = stop

    def n_group_links(self) -> np.ndarray:
        """Per text how many pairs of tokens are in the same group."""
        each = np.bincount(self.group_a, minlength=self.groups) * np.bincount(self.group_b, minlength=self.groups)
        out = np.zeros(int(self.text_of_group[-1]) + 1 if self.groups else 0, dtype=np.int64)
        np.add.at(out, self.text_of_group, each)
        return out

    def group_texts(self, a: Coder, b: Coder, texts: int) -> list[str]:
        """Per text its groups, ids in decimal: ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        members_a = by_groups(self.group_a, self.groups).transposed()
        members_b = by_groups(self.group_b, self.groups).transposed()
        # groups in order, in each the tokens of A and then those of B
        place_a = np.arange(len(self.ids_a)) + members_b.start[self.group_a]
        place_b = np.arange(len(self.ids_b)) + members_a.start[self.group_b + 1]
        last_a = np.zeros(len(self.ids_a), dtype=bool)
        last_b = np.zeros(len(self.ids_b), dtype=bool)
        last_a[members_a.start[1:] - 1] = True
        last_b[members_b.start[1:] - 1] = True
        final = np.r_[self.text_of_group[1:] != self.text_of_group[:-1], True][: self.groups]
        end_a = np.where(last_a, 2, 1)
        end_b = np.where(last_b, np.where(final[self.group_b], 0, 3), 1)
        words = np.empty(len(place_a) + len(place_b), dtype=object)
        for end, name in enumerate(a.numbers):
            some = end_a == end
            words[place_a[some]] = [name[i] for i in self.ids_a[some].tolist()]
        for end, name in enumerate(b.numbers):
            some = end_b == end
            words[place_b[some]] = [name[i] for i in self.ids_b[some].tolist()]
        stops = np.searchsorted(self.text_a, np.arange(texts + 1)) + np.searchsorted(self.text_b, np.arange(texts + 1))
        words = words.tolist()
        return ["".join(words[x:y]) for x, y in zip(stops[:-1].tolist(), stops[1:].tolist())]


def align(texts: list[str | None], a: Coder, b: Coder) -> Aligned:
    """The tokens of the texts, their overlaps and groups; a text that is not spelled again has none."""
    cut = [CUT.split(t or "") for t in texts]
    (ids_a, text_a, good_a), (ids_b, text_b, good_b) = a.tokens(cut), b.tokens(cut)
    good = good_a & good_b & np.array([bool(t) for t in texts], dtype=bool)
    ids_a, text_a = ids_a[good[text_a]], text_a[good[text_a]]
    ids_b, text_b = ids_b[good[text_b]], text_b[good[text_b]]
    left, right = by_bytes(a.lengths[ids_a]), by_bytes(b.lengths[ids_b])
    links = product(left, right.transposed())
    ends_a, ends_b = left.start[1:], right.start[1:]
    ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return Aligned(
        ids_a, ids_b, text_a, text_b, np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b),
        text_a[np.searchsorted(ends_a, ends)], links,
    )


def aligned_batches(batches: Iterator[pa.RecordBatch], files: tuple[bytes, bytes]) -> Iterator[tuple[pa.RecordBatch, Aligned, Coder, Coder]]:
    a, b = coder(byte_level_coder, files[0]), coder(piece_coder, files[1])
    for part in pieces(batches, BLOCK):
        yield part, align(part.column("text").to_pylist(), a, b), a, b


def lists(values: np.ndarray, owner: np.ndarray, rows: int) -> pa.ListArray:
    """One list per row; ``owner`` is sorted."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)), pa.array(values))


def token_links(docs: DataFrame, a_file: str = BYTE_LEVEL, b_file: str = PIECES) -> DataFrame:
    """Per document the ids of both tokenizers, the group of every token, and the links.

    ``link_a`` and ``link_b`` are positions in ``ids_a`` and ``ids_b``, ``shared_bytes`` their overlap; groups
    count from 0 in each document.
    """
    shared = docs.sparkSession.sparkContext.broadcast((read_file(a_file), read_file(b_file)))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found, *_ in aligned_batches(batches, shared.value):
            n = part.num_rows
            row, column, value = found.links
            of = found.text_a[row]
            first_a, first_b = (np.searchsorted(t, np.arange(n)) for t in (found.text_a, found.text_b))
            first_group = np.searchsorted(found.text_of_group, np.arange(n))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    lists(found.ids_a.astype(np.int32), found.text_a, n), lists(found.ids_b.astype(np.int32), found.text_b, n),
                    lists((found.group_a - first_group[found.text_a]).astype(np.int32), found.text_a, n),
                    lists((found.group_b - first_group[found.text_b]).astype(np.int32), found.text_b, n),
                    lists((row - first_a[of]).astype(np.int32), of, n), lists((column - first_b[of]).astype(np.int32), of, n),
                    lists(value.astype(np.int32), of, n),
                ],
                names=["doc_id", "ids_a", "ids_b", "group_a", "group_b", "link_a", "link_b", "shared_bytes"],
            )

    each = ", ".join(f"{c} array<int>" for c in ("ids_a", "ids_b", "group_a", "group_b", "link_a", "link_b", "shared_bytes"))
    return docs.select("doc_id", "text").mapInArrow(link, f"doc_id long, {each}")


def documents_links(docs: DataFrame, a_file: str = BYTE_LEVEL, b_file: str = PIECES) -> DataFrame:
    """Per document its numbers, and its distinct linked id pairs (A id * 2^32 + B id) with their times."""
    shared = docs.sparkSession.sparkContext.broadcast((read_file(a_file), read_file(b_file)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found, a, b in aligned_batches(batches, shared.value):
            n = part.num_rows
            row, column, _ = found.links
            of, pair = found.text_a[row], found.ids_a[row] << 32 | found.ids_b[column]
            order = np.lexsort((pair, of))
            of_, pair_ = of[order], pair[order]
            first = np.flatnonzero(np.r_[True, (of_[1:] != of_[:-1]) | (pair_[1:] != pair_[:-1])][: len(of_)])
            times = np.diff(np.r_[first, len(of_)])
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.group_texts(a, b, n)]
            same = np.zeros(n, dtype=np.int64)
            within = found.n_group_links()
            same[: len(within)] = within
            counts = [np.bincount(x, minlength=n) for x in (found.text_a, found.text_b, found.text_of_group, of)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()), *map(pa.array, counts), pa.array(same), pa.array(digests),
                    lists(pair_[first], of_[first], n), lists(times.astype(np.int32), of_[first], n),
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups_sha256", "pairs", "times"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        count,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups_sha256 string, "
        "pairs array<long>, times array<int>",
    )


def pair_counts(links: DataFrame) -> DataFrame:
    """pair, docs (documents that hold it linked) and best (0 or 1: no pair of its A id has more)."""
    counts = links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    counts = settle(counts, "pairs")
    a_id = F.shiftright("pair", 32)
    most = settle(counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("most")), "best")
    joined = counts.join(most, a_id == F.col("a"))
    return settle(joined.select("pair", "docs", (F.col("docs") == F.col("most")).cast("long").alias("best")), "pairs")


def common_from(counts: DataFrame, limit: int) -> int:
    """A power of two: at most ``limit`` pairs occur in so many documents or more."""
    size = F.floor(F.log2("docs")).cast("int")
    left = limit
    for r in counts.groupBy(size.alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("size")).collect():
        left -= r["n"]
        if left < 0:
            return 2 << r["size"]
    return 1


def with_counts(links: DataFrame, common: int = COMMON) -> DataFrame:
    """The written ``links`` with n_best and count_sum over the whole corpus."""
    counts = pair_counts(links)
    least = common_from(counts, common)
    known = counts.filter(F.col("docs") >= least).toArrow()
    order = np.argsort(known.column("pair").to_numpy())
    arrays = tuple(known.column(c).to_numpy()[order] for c in ("pair", "docs", "best"))
    shared = links.sparkSession.sparkContext.broadcast(arrays)
    numbers = [c for c in links.columns if c not in ("row", "pairs", "times")]

    def look_up(batch: pa.RecordBatch):
        pair, docs, best = shared.value
        pairs = batch.column("pairs")
        owner = np.repeat(np.arange(batch.num_rows), list_lengths(pairs))
        codes, times = pairs.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
        at = np.searchsorted(pair, codes)
        at[at == len(pair)] = 0
        here = pair[at] == codes if len(pair) else np.zeros(len(codes), dtype=bool)
        return owner, codes, times, at, here

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, _, times, at, here = look_up(batch)
            _, docs, best = shared.value
            sums = [np.zeros(batch.num_rows, dtype=np.int64) for _ in range(2)]
            for out, value in zip(sums, (best, docs)):
                if here.any():
                    np.add.at(out, owner[here], times[here] * value[at[here]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", *numbers)] + [pa.array(s) for s in sums], names=["row", *numbers, "n_best", "count_sum"]
            )

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, codes, times, _, here = look_up(batch)
            rows = batch.column("row").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[owner[~here]]), pa.array(codes[~here]), pa.array(times[~here])], names=["row", "pair", "times"]
            )

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in links.schema if f.name in numbers)
    summed = links.mapInArrow(add, f"row long, {types}, n_best long, count_sum long")
    if least == 1:
        return summed.drop("row")
    others = links.select("row", "pairs", "times").mapInArrow(rare, "row long, pair long, times long")
    per_row = others.join(counts.filter(F.col("docs") < least), "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("best")).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more_sum")
    )
    both = summed.join(per_row, "row", "left")
    more = [(F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))]
    return both.select(*numbers, *more)


def list_lengths(column: pa.ListArray) -> np.ndarray:
    return np.diff(column.offsets.to_numpy())


def aligned_documents(docs: DataFrame, a_file: str = BYTE_LEVEL, b_file: str = PIECES, common: int = COMMON) -> DataFrame:
    """Per document n_a, n_b, n_groups, n_links, n_group_links, groups_sha256, n_best and count_sum."""
    links = documents_links(docs, a_file, b_file).withColumn("row", F.monotonically_increasing_id())
    return with_counts(settle(links, "links"), common)
