"""Whitening against plain cross-products and eigenvectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareflow.llm import whitening


def plain(rows, components=32):
    """vec_id -> (deviation, covariance's projections by component) of vectors of one length, and the facts."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(good), len(good[0][1])
    sums = [sum(x[k] for _, x in good) for k in range(d)]
    cov = np.array([[sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for _, x in good) / n**3 for b in range(d)] for a in range(d)])
    deviation = sorted((i, sum((n * x[k] - sums[k]) ** 2 for k in range(d))) for i, x in good)
    return n, cov, deviation, {i: np.array([(n * x[k] - sums[k]) / n for k in range(d)]) for i, x in good}


def result(spark, rows, kind="array<float>", **more):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding {kind}")
    for name in ("size", "i", "n", "whitened"):
        frame = frame.withColumn(name, F.lit("x"))
    return whitening.whitened_components(frame, **more).collect()


@pytest.mark.parametrize("scale", [1.0, 1e3, 1e9])
def test_scatter_is_exact(scale):
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(333, 7)) * scale).astype(np.int64)
    x[:, 3] = 5
    sums, products = whitening.scatter(x)
    whole = x.astype(object)
    assert (products == whole.T.dot(whole)).all() and (sums == whole.sum(axis=0)).all()


def test_against_plain_whitening(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000, None), (1001, [None] * 6), (1002, [math.nan] + [0.0] * 5), (1003, [math.inf] * 6), (1004, [])]
    n, cov, deviation, off = plain(rows[:301])
    got = result(spark, rows)
    assert len(got) == 300 * 6 and {r.n for r in got} == {n}
    assert sorted({(r.vec_id, r.deviation) for r in got}) == deviation
    values, vectors = np.linalg.eigh(cov)
    for r in got:
        k = 6 - r.component
        want = off[r.vec_id] @ vectors[:, k] / math.sqrt(values[k])
        assert abs(abs(r.whitened) - abs(want)) < 1e-8
        assert r.explained == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
        assert r.identity_error < 1e-9
    table = np.array([r.whitened for r in sorted(got, key=lambda r: (r.component, r.vec_id))]).reshape(6, 300)
    assert np.abs(table @ table.T / 300 - np.eye(6)).max() < 1e-9


def test_odd_vectors(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None), (2, [])]) == []
    assert result(spark, [(1, [1.0, 2.0])]) == []  # no variance
    # constant and dependent dimensions are left out, repeats and null ids count
    rows = [(1, [0.0, 1.0, 2.0]), (1, [0.0, 1.0, 2.0]), (None, [4.0, 1.0, 10.0]), (2, [2.0, 1.0, 6.0])]
    got = result(spark, rows)
    assert len(got) == 4 and {r.component for r in got} == {1} and {r.n for r in got} == {4}
    assert got[0].explained == pytest.approx(1.0)
    assert sum(r.whitened**2 for r in got) / 4 == pytest.approx(1.0)
    # every length has its own fit
    rows += [(7, [1.0]), (8, [3.0]), (9, [3.0])]
    got = result(spark, rows)
    assert {(r.vec_id, r.n) for r in got if r.n == 3} == {(7, 3), (8, 3), (9, 3)} and len(got) == 7


def test_large_entries_and_few_components(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(c) for c in rng.normal(size=4) * 1e12]) for i in range(50)]
    got = result(spark, rows, "array<double>", components=2)
    assert {r.component for r in got} == {1, 2} and len(got) == 100
    assert all(r.deviation is None and r.identity_error < 1e-9 for r in got)
    with pytest.raises(Exception, match="cannot be whole numbers"):
        result(spark, [(1, [1e30])], "array<double>")
