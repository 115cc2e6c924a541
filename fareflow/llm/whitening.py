"""Whitening of embeddings from exact cross-products, by a bit-sliced scatter.

1. Entries become whole numbers, floor(scale * entry); a constant added to all of them, as some
   formats have it, drops out of every result, as all are of differences. In a task each block of rows is shifted per dimension to start at
   0 and cut into bit planes; the bits of a plane are packed into 64-bit words, 64 rows a word. The
   cross-product of two dimensions is the sum over their planes of 2^(k+l) times the number of
   bits that both planes have set: words are ANDed and their bits counted. Shifts are taken out again
   in whole numbers, so every task gives exact sums and cross-products, whatever its blocks were.
2. Spark adds up the tasks' sums, one row per pair of dimensions. The driver gets that many and
   no more (``DIMENSIONS`` bounds them), centres them in whole numbers, n * Q - S * S, and only
   then divides and takes eigenvectors.
3. A second scan measures the covariance of the whitened vectors, a third one projects.

Rows: null vectors and vectors with a null or non-finite entry are dropped; repeated rows and
repeated or null ids count as rows of their own; vectors of different length are whitened apart,
each length with a fit of its own; empty vectors and empty input give nothing. Directions without
variance (fewer rows than dimensions, constant or dependent dimensions) have no whitened values and
are left out. Equal eigenvalues give some orthogonal choice of their directions. Whole numbers must
fit a long. Columns besides the id and the vector are not looked at.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
COMPONENTS = 32
#: Longest vectors that are whitened: the driver holds a square matrix of this size.
DIMENSIONS = 2048
#: Rows of a block (a multiple of 64), and cells of a block at most.
BLOCK, CELLS = 4096, 1 << 22
#: A direction counts if its variance is more than this share of the largest, times dimensions.
NEGLIGIBLE = 1e-13


@dataclass(frozen=True)
class Whitening:
    """A fit to ``n`` vectors; ``vectors`` holds one component per column."""

    n: int
    sums: np.ndarray
    variances: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray


def whole_numbers(batch: pa.RecordBatch, scale: int = SCALE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per vector length of a batch the row numbers of its usable vectors, and floor(scale * entry) of them."""
    column = batch.column("embedding")
    present = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    bad = np.r_[0, np.cumsum(~np.isfinite(values))]
    usable = present & (bad[ends] == bad[ends - lengths]) & (lengths > 0)
    for size in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == size))
        step = max(64, min(BLOCK, CELLS // size // 64 * 64))
        for begin in range(0, len(rows), step):
            some = rows[begin : begin + step]
            cells = np.floor(scale * values[(ends[some] - size)[:, None] + np.arange(size)])
            if np.abs(cells).max() >= 2.0**62:
                raise ValueError(f"entries beyond 2^62 / {scale} cannot be whole numbers")
            yield some, cells.astype(np.int64)


def bit_planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed planes (plane, word) of non-negative columns, each plane's bit number, and each column's first plane."""
    bits = np.maximum(1, [int(m).bit_length() for m in x.max(axis=0)])
    first = np.r_[0, np.cumsum(bits)[:-1]]
    number = np.arange(bits.sum()) - np.repeat(first, bits)
    words = -(-len(x) // 64)
    packed = np.zeros((len(number), words * 8), dtype=np.uint8)
    for k in range(int(bits.max())):
        has = np.flatnonzero(bits > k)
        plane = np.packbits(((x[:, has] >> k) & 1).astype(np.uint8), axis=0)
        packed[first[has] + k, : len(plane)] = plane.T
    return packed.view(np.uint64), number, first


def cross_products(x: np.ndarray) -> np.ndarray:
    """Sums of products of the columns of non-negative whole numbers, exact (Python integers if need be)."""
    planes, number, first = bit_planes(x)
    counts = np.zeros((len(planes), len(planes)), dtype=np.int64)
    for p in range(len(planes)):
        counts[p, p:] = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
    counts += np.triu(counts, 1).T
    most = 2 * int(number.max()) + 2 + len(x).bit_length()
    weight = np.array([1 << k for k in number.tolist()], dtype=np.int64 if most < 62 else object)
    weighted = np.add.reduceat(counts * weight, first, axis=1)
    return np.add.reduceat(weighted * weight[:, None], first, axis=0)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products of the columns of whole numbers of either sign."""
    low = x.min(axis=0)
    y = x - low
    low, sums = low.astype(object), y.sum(axis=0, dtype=object)
    q = cross_products(y).astype(object) + np.outer(low, sums) + np.outer(sums, low) + len(x) * np.outer(low, low)
    return sums + len(x) * low, q


def decimals(values: np.ndarray) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def sums_of(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """size, i, j, n, s (sum of entry i) and q (cross-product of i and j), i <= j, over all vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for rows, x in whole_numbers(batch, scale):
                size = x.shape[1]
                if size > DIMENSIONS:
                    raise ValueError(f"vectors of {size} entries: at most {DIMENSIONS} can be whitened")
                s, q = scatter(x)
                n_, s_, q_ = held.get(size, (0, 0, 0))
                held[size] = [n_ + len(rows), s_ + s, q_ + q]
        for size, (n, s, q) in held.items():
            i, j = np.triu_indices(size)
            for begin in range(0, len(i), 1 << 16):
                a, b = i[begin : begin + (1 << 16)], j[begin : begin + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), size, np.int32)), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                     pa.array(np.full(len(a), n)), decimals(s[a]), decimals(q[a, b])],
                    names=["size", "i", "j", "n", "s", "q"],
                )

    found = vectors.select("embedding").mapInArrow(add, "size int, i int, j int, n long, s decimal(38,0), q decimal(38,0)")
    return found.groupBy("size", "i", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))


def fitted(size: int, rows: list[dict], components: int = COMPONENTS) -> Whitening:
    """Centre whole numbers, then divide, then take eigenvectors; the sign makes the largest entry positive."""
    n = rows[0]["n"]
    sums = np.zeros(size, dtype=object)
    products = np.zeros((size, size), dtype=object)
    for r in rows:
        products[r["i"], r["j"]] = products[r["j"], r["i"]] = int(r["q"])
        if r["i"] == r["j"]:
            sums[r["i"]] = int(r["s"])
    centred = n * products - np.outer(sums, sums)
    covariance = np.array([[v / (n * n) for v in row] for row in centred.tolist()])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    trace = sum(centred[k, k] for k in range(size)) / (n * n)
    kept = np.flatnonzero(values > NEGLIGIBLE * size * max(values[0], 0.0))[:components]
    vectors = vectors[:, kept]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(kept))]
    explained = values[kept] / trace if trace else values[kept]
    return Whitening(n, sums, values[kept], vectors * np.where(largest < 0, -1.0, 1.0), explained)


def fit(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> dict[int, Whitening]:
    """A whitening per vector length, from all vectors."""
    by_size: dict[int, list[dict]] = {}
    for batch in sums_of(vectors, scale).toArrow().to_batches():
        for r in batch.to_pylist():
            by_size.setdefault(r["size"], []).append(r)
    return {size: fitted(size, rows, components) for size, rows in by_size.items()}


def centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exact: a matrix of longs, or of Python integers where those might not do."""
    most = model.n * int(np.abs(x).max(initial=0)) + max(map(abs, model.sums.tolist()))
    if most < 2**62:
        return model.n * x - model.sums.astype(np.int64)
    return model.n * x.astype(object) - model.sums


def projected(off: np.ndarray, model: Whitening) -> np.ndarray:
    return (off / model.n).astype(np.float64) @ (model.vectors / np.sqrt(model.variances))


def squares(off: np.ndarray) -> list[int]:
    """Exact sums of squares per row."""
    if off.dtype != object and float(np.abs(off).max(initial=0)) ** 2 * off.shape[1] < 2.0**62:
        return (off * off).sum(axis=1).tolist()
    return (off.astype(object) ** 2).sum(axis=1).tolist()


def whiten(vectors: DataFrame, models: dict[int, Whitening], scale: int = SCALE) -> DataFrame:
    """vec_id, size, deviation (decimal(38,0)) and whitened (array<double>, one entry per component)."""
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in whole_numbers(batch, scale):
                model = shared.value[x.shape[1]]
                off = centred(x, model)
                w = projected(off, model)
                ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
                lists = pa.ListArray.from_arrays(ends, pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)).cast(pa.int64()), pa.array(np.full(len(w), x.shape[1], np.int32)),
                     decimals(squares(off)), lists],
                    names=["vec_id", "size", "deviation", "whitened"],
                )

    found = vectors.select("vec_id", "embedding")
    return found.mapInArrow(apply, "vec_id long, size int, deviation decimal(38,0), whitened array<double>")


def identity_errors(vectors: DataFrame, models: dict[int, Whitening], scale: int = SCALE) -> dict[int, float]:
    """Per length the largest entry of the whitened vectors' covariance minus the identity, from all of them.

    A task centres its own vectors before it multiplies; the driver puts the tasks' sums together,
    a row per pair of components.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for _, x in whole_numbers(batch, scale):
                model = shared.value[x.shape[1]]
                w = projected(centred(x, model), model)
                mean = w.mean(axis=0)
                spread = (w - mean).T @ (w - mean)
                if x.shape[1] in held:
                    n, m, c = held[x.shape[1]]
                    gap, all_ = mean - m, n + len(w)
                    spread = c + spread + np.outer(gap, gap) * (n * len(w) / all_)
                    mean, count = m + gap * (len(w) / all_), all_
                else:
                    count = len(w)
                held[x.shape[1]] = (count, mean, spread)
        for size, (n, mean, spread) in held.items():
            i, j = np.triu_indices(len(mean))
            columns = [np.full(len(i), size, np.int32), i.astype(np.int32), j.astype(np.int32), np.full(len(i), float(n)),
                       mean[i] * n, mean[j] * n, spread[i, j] + n * mean[i] * mean[j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["size", "i", "j", "n", "a", "b", "c"])

    found = vectors.select("embedding").mapInArrow(add, "size int, i int, j int, n double, a double, b double, c double")
    covariance = F.sum("c") / F.sum("n") - F.sum("a") / F.sum("n") * F.sum("b") / F.sum("n")
    entries = found.groupBy("size", "i", "j").agg(covariance.alias("v"))
    off = F.abs(F.col("v") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return {r["size"]: r["error"] for r in entries.groupBy("size").agg(F.max(off).alias("error")).collect()}


def whitened_components(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is null where it does not fit a long.
    """
    models = fit(vectors, components, scale)
    errors = identity_errors(vectors, models, scale)
    facts = [(size, m.n, [float(e) for e in m.explained], errors.get(size)) for size, m in models.items()]
    known = vectors.sparkSession.createDataFrame(facts, "size int, n long, shares array<double>, identity_error double")
    rows = whiten(vectors, models, scale).join(F.broadcast(known), "size")
    each = rows.select(
        "vec_id", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), "identity_error", "shares",
        F.posexplode("whitened").alias("at", "whitened"),
    )
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.element_at("shares", F.col("at") + 1).alias("explained"), "identity_error",
    )
