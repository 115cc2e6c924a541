"""Exact top-k inner products by aggregation of sorted lists, without random access.

Queries meet the candidates in blocks of bounded size. In a block every dimension is a sorted
list, read from the top where a query's weight is positive and from the bottom where it is
negative. After reading to some depth, what was not read lies between the list's frontier and
its far end, so each candidate has a lower and an upper bound of its score. A query stops once few
candidates can still qualify; these get their scores in full. Its best of all blocks are merged.

Rows: null ids, null vectors and vectors with a null or non-finite component take no part; equal
rows count once; rows that repeat an id with another vector are candidates of their own, but never
of a query with that id; vectors are only compared with vectors of their length; ties go to the
smaller id; empty input gives empty output. Other columns are not looked at. Scores must fit a long.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.workspace import settle

K = 5
SCALE = 256
CANDIDATES, QUERIES = 4096, 1024
#: Shares of the lists that are read before the bounds are looked at.
DEPTHS = (0.25, 0.5, 0.75, 1.0)
#: A query stops reading when at most this many times k candidates can qualify.
FEW = 8


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and parts: whole numbers of the vectors that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    parts = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), parts.alias("parts")).distinct()


def matrix(table: pa.Table) -> np.ndarray:
    column = table.column("parts").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def number_type(x: np.ndarray, y: np.ndarray) -> type:
    """The fastest type in which all sums of products are exact."""
    most = max(1, x.shape[1]) * float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0))
    return np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64


def best_in_block(
    ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, y: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of the k best candidates of every query."""
    kind = number_type(x, y)
    x, y = x.astype(kind), y.astype(kind)
    lists = np.sort(x, axis=0)
    weights = np.concatenate((np.maximum(y, 0), np.minimum(y, 0)), axis=1)
    least = np.finfo(kind).min if kind is not np.int64 else np.iinfo(np.int64).min
    open_ = np.arange(len(y))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    n = len(x)
    for share in DEPTHS:
        if not len(open_):
            break
        depth = max(1, int(np.ceil(share * n)))
        top, bottom = lists[n - depth], lists[depth - 1]
        read = np.concatenate((np.maximum(x, top), np.minimum(x, bottom)), axis=1)
        upper = weights[open_] @ read.T
        own = ids[None, :] == query_ids[open_][:, None]
        upper[own] = least
        if depth < n:
            far = np.concatenate((np.where(x >= top, x, lists[0]), np.where(x <= bottom, x, lists[-1])), axis=1)
            lower = weights[open_] @ far.T
            lower[own] = least
        else:
            lower = upper
        kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(open_), least, dtype=kind)
        able = (upper >= kth[:, None]) & ~own
        stop = (able.sum(axis=1) <= FEW * k) | (depth == n)
        rows, candidates = np.nonzero(able[stop])
        found.append((open_[stop][rows], candidates))
        open_ = open_[~stop]
    rows, candidates = (np.concatenate(v) for v in zip(*found)) if found else (np.zeros(0, int),) * 2
    if not len(rows):
        return rows, candidates, np.zeros(0, dtype=np.int64)
    step = max(1, (1 << 22) // max(1, x.shape[1]))
    parts = [(x[candidates[s : s + step]] * y[rows[s : s + step]]).sum(axis=1) for s in range(0, len(rows), step)]
    scores = np.concatenate(parts).astype(np.int64)
    order = np.lexsort((ids[candidates], -scores, rows))
    rows, candidates, scores = rows[order], candidates[order], scores[order]
    first = np.searchsorted(rows, rows, side="left")
    kept = np.arange(len(rows)) - first < k
    return rows[kept], candidates[kept], scores[kept]


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of every query's k best candidates.

    Every candidate goes to each block of queries and every query to each block of candidates;
    block sizes are fixed, so a task's memory is too, and the merge gets k rows per query and block.
    """
    parts = settle(scaled(vectors, scale), "vectors")
    queries = parts.filter(is_query)
    blocks = max(1, -(-parts.count() // CANDIDATES))
    groups = max(1, -(-queries.count() // QUERIES))
    key = ["size", "block", "part"]
    left = parts.select(
        "vec_id", "parts", F.size("parts").alias("size"),
        F.pmod(F.xxhash64("vec_id", "parts"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"),
    )
    right = queries.select(
        "vec_id", "parts", F.size("parts").alias("size"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("parts", "vec_id"), F.lit(groups)).cast("int").alias("part"),
    )

    def search(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        ids, query_ids = candidates.column("vec_id").to_numpy(), asked.column("vec_id").to_numpy()
        if len(ids) and len(query_ids):
            rows, at, scores = best_in_block(ids, matrix(candidates), query_ids, matrix(asked), k)
        else:
            rows = at = scores = np.zeros(0, dtype=np.int64)
        marks = asked.column("mark").to_numpy()
        return pa.table({"query_id": query_ids[rows], "mark": marks[rows], "vec_id": ids[at], "score": scores})

    right = right.withColumn("mark", F.xxhash64("parts"))
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        search, "query_id long, mark long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
