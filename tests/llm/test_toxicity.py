"""The ordinal model, its sample, and what it does on the given labels."""

import math
import random

import numpy as np
import odd
import regex
import xxhash
from pyspark.sql import functions as F

from fareflow.llm import toxicity
from fareflow.llm.queries import op9_toxicity, toxicity_model
from fareflow.llm.texts import table


def graded(rng, n):
    """Texts whose grade is the number of bad words: none, one or two, more."""
    out = []
    for k in range(n):
        bad = k % 3 and rng.choice((1, 2) if k % 3 == 1 else (5, 6))
        words = rng.choices([f"w{i}" for i in "abcdefgh"], k=30) + rng.choices(["nasty", "vile"], k=bad)
        rng.shuffle(words)
        out.append((k, " ".join(words), "en", "s", k % 3))
    return out


def trained(spark, rows, **options):
    docs = odd.documents(spark, [r[:4] for r in rows])
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows], "doc_id long, grade int")
    return docs, toxicity.train(docs, labels, F.col("grade"), **options)


def test_grades_share_weights_and_thresholds_are_ordered(spark):
    docs, model = trained(spark, graded(random.Random(0), 300))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    rows = {r["doc_id"]: r for r in toxicity.severity(docs, model).collect()}
    assert np.mean([rows[k]["grade"] == k % 3 for k in rows]) > 0.9
    means = [np.mean([r["severity"] for k, r in rows.items() if k % 3 == g]) for g in range(3)]
    assert means[0] < 0.4 < means[1] < 1.4 < means[2]


def test_gradient_descent_reaches_the_best_likelihood():
    rng = np.random.default_rng(0)
    rows = [({1: int(x)}, int(y), 1.0) for x, y in zip(rng.integers(0, 5, 200), rng.integers(0, 3, 200))]

    def loss(w, a, b):
        s = lambda v: 1 / (1 + np.exp(-v))
        p = [(s(a - w * min(x[1], 4)), s(b - w * min(x[1], 4))) for x, _, _ in rows]
        return -np.mean([np.log((lo, hi - lo, 1 - hi)[y]) for (lo, hi), (_, y, _) in zip(p, rows)])

    model = toxicity.fit(rows, [1])
    best = min(loss(w, a, b) for w in np.linspace(-0.3, 0.3, 13) for a in np.linspace(-1.5, 0.5, 21) for b in np.linspace(0, 2, 21) if a < b)
    assert loss(model.weights[1], *model.thresholds) <= best + 0.002


def test_sample_is_bounded_and_weighted(spark):
    rows = graded(random.Random(1), 90)
    docs = odd.documents(spark, [r[:4] for r in rows])
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows] + [(None, 1), (5, None), (10**6, 2), (0, 0)], "doc_id long, grade int")
    got = toxicity.labelled_sample(docs, labels, F.col("grade"), 10).collect()
    assert len(got) == 30 and {r["weight"] for r in got} == {3.0}
    again = toxicity.labelled_sample(docs.repartition(3), labels, F.col("grade"), 10).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in again}


def test_odd_rows_and_no_labels(spark):
    docs, model = trained(spark, graded(random.Random(2), 120))
    assert toxicity.severity(odd.odd_documents(spark), model).count() == len(odd.ODD)
    assert toxicity.severity(odd.no_documents(spark), model).count() == 0
    assert toxicity.without_toxic(odd.odd_documents(spark), model).count() == len(odd.ODD)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] % 3 for r in kept.collect()} == {0}
    _, nothing = trained(spark, [(1, "one grade only", "en", "s", 0)])
    assert nothing is None
    assert {r["severity"] for r in toxicity.severity(odd.odd_documents(spark), nothing).collect()} == {0.0}
    assert toxicity.train(docs, spark.createDataFrame([], "doc_id long, grade int"), F.col("grade")) is None


def plain_scores(model, text):
    """Severity, grade and P(grade > 0) of one text, feature by feature."""
    counts = {}
    for word in regex.findall(r"[\p{L}\p{M}]+", text or ""):
        word = word.lower()
        for name in [f"={word}", *(f"{word[:k]}-" for k in (4, 5, 6) if len(word) > k)]:
            key = xxhash.xxh64_intdigest(name) >> 1
            counts[key] = counts.get(key, 0) + 1
    x = sum(model.weights.get(k, 0.0) * min(n, 4) for k, n in counts.items())
    below = [1 / (1 + math.exp(-max(-500, min(500, t - x)))) for t in model.thresholds] + [1.0]
    chances = [b - a for a, b in zip([0.0, *below], below)]
    return sum(g * c for g, c in enumerate(chances)), chances.index(max(chances)), 1 - below[0]


def test_scores_against_a_plain_version(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = toxicity_model(spark, docs, "/root/testdata/sf0.001")
    docs = docs.select("doc_id", "text").union(odd.odd_documents(spark).select(F.col("doc_id") + 10**6, "text"))
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    rows = [r for r in toxicity.severity(docs, model).collect() if r.doc_id is not None]
    assert len(rows) >= len(texts)
    for r in rows:
        severity, grade, p = plain_scores(model, texts[r.doc_id])
        assert abs(r.severity - severity) < 1e-9 and abs(r.p_toxic - p) < 1e-9
        assert r.grade == grade or abs(severity % 1 - 0.5) < 0.1


def test_very_long_texts_stay_in_the_fitted_range(spark):
    docs, model = trained(spark, graded(random.Random(3), 300))
    rng = random.Random(4)
    clean = " ".join(rng.choices([f"w{i}" for i in "abcdefgh"], k=200_000))
    toxic = clean + " nasty vile nasty vile nasty vile" + clean[:100]
    rows = {r.doc_id: r for r in toxicity.severity(odd.documents(spark, [(1, clean), (2, toxic)]), model).collect()}
    assert rows[1].p_toxic < 0.5 < rows[2].p_toxic


def test_held_out_labels_are_met(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    kept_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    model = toxicity.train(docs, labels.filter(~kept_out), F.col("toxic"), binary=True)
    known = labels.filter(kept_out).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    asked = docs.join(known, F.col("doc_id") == F.col("id"), "left_semi")
    rows = toxicity.severity(asked, model).join(known, F.col("doc_id") == F.col("id"))
    counts = {(r.label, r.bad): r["count"] for r in rows.groupBy("label", (F.col("p_toxic") >= toxicity.REJECT).alias("bad")).count().collect()}
    assert counts[1, True] > 0.9 * (counts[1, True] + counts.get((1, False), 0))
    assert counts.get((0, True), 0) < 0.01 * counts[0, False]


def test_given_labels_are_met(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    rows = op9_toxicity(spark, sf_dir).join(labels, "doc_id").groupBy("label", "toxic").count().collect()
    counts = {(r["label"], r["toxic"]): r["count"] for r in rows}
    assert counts[1, True] > 0.93 * (counts[1, True] + counts.get((1, False), 0))
    assert counts.get((0, True), 0) < 0.005 * counts[0, False]
