"""Top-k by bounds against all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareflow.llm import topk


def plain_top(rows, k=5):
    good = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, y in good:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, x in good if i != q and len(x) == len(y))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def searched(spark, rows):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("part", F.lit("x"))
    return {tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 50 == 0).collect()}


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, -2.0]), (50, [0.5, 0.25]), (1, [1.0, -2.0]), (2, [1.0, -2.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (7, [1.0]), (8, []), (None, [1.0, 1.0]), (9, [0.0, 0.0]), (9, [0.0, 0.0]), (9, [3.0, 0.5]), (100, [2.0]),
    ]
    assert searched(spark, rows) == plain_top(rows)
    assert searched(spark, []) == set()
    assert searched(spark, rows[2:5]) == set()


def test_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(400)]
    rows += [(i + 1000, v) for i, v in rows[:30]]
    assert searched(spark, rows) == plain_top(rows)


@pytest.mark.parametrize("scale", [1, 1e4, 1e7])
def test_bounds_in_every_number_type(scale):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(300, 8)) * scale * 50).astype(np.int64)
    ids, y = np.arange(300), x[:20]
    rows, at, scores = topk.best_in_block(ids, x, ids[:20], y, 5)
    full = x @ y.T
    for q in range(20):
        order = sorted((-int(full[i, q]), i) for i in range(300) if i != q)[:5]
        assert [(-s, i) for s, i in order] == [(int(s), int(i)) for r, i, s in zip(rows, at, scores) if r == q]
