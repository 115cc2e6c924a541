"""Severity grades by cumulative-link ordinal regression on sparse text features.

Features are hashed words and the first letters of words, counted. One weight vector is shared by
all thresholds: P(grade <= k) = sigmoid(threshold_k - weights . x), thresholds kept in order. The
model is fitted on a bounded sample of labelled documents (``SAMPLE`` per class, smallest id
hashes first, weighted back to all labelled ones); scoring reads every word of every document.

Where labels say only toxic or not, the grade of a toxic document is how often it has features
that are found almost only in toxic documents: ``SEVERE`` and more of such words make grade 2.

Rows: null and empty texts have no features, hence the lowest severity that the thresholds give;
repeated rows are scored one by one; label rows with a null id or grade, or without a document,
teach nothing; without labelled rows of two grades every document gets severity 0. Columns
besides ``doc_id`` and ``text`` are not looked at.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.texts import pieces
from fareflow.workspace import settle

WORD = regex.compile(r"[\p{L}\p{M}]+")
PREFIXES = (4, 5, 6)
#: Labelled documents to learn from, at most, per class.
SAMPLE = 4_000
#: Features kept, and the least number of sampled documents that have one.
FEATURES, LEAST_DOCS = 4_096, 5
SEVERE = 4
#: Times that a feature counts in a document, at most.
MOST = 4
REJECT = 0.5
CACHE = 400_000


@dataclass
class OrdinalModel:
    """Feature weights and ordered thresholds."""

    weights: dict[int, float]
    thresholds: list[float]

    def at_most(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= k) per document and threshold."""
        return 1 / (1 + np.exp(-np.clip(np.array(self.thresholds)[None, :] - score[:, None], -500, 500)))


def features_of(word: str) -> list[int]:
    """Hashes of the word and of its first letters."""
    word = word.lower()
    names = [f"={word}", *(f"{word[:k]}-" for k in PREFIXES if len(word) > k)]
    return [xxhash.xxh64_intdigest(n) >> 1 for n in names]


def counted(text: str) -> dict[int, int]:
    """Feature counts of a whole text."""
    words: dict[str, int] = {}
    for word in WORD.findall(text):
        words[word] = words.get(word, 0) + 1
    out: dict[int, int] = {}
    for word, n in words.items():
        for f in features_of(word):
            out[f] = out.get(f, 0) + n
    return out


def capped(n: int) -> int:
    """What a feature that occurs ``n`` times counts, to learn from and to score: long texts stay in the fitted range."""
    return min(n, MOST)


def labelled_sample(docs: DataFrame, labels: DataFrame, grade: Column, size: int = SAMPLE) -> DataFrame:
    """doc_id, text, grade (0 or more) and weight of at most ``size`` documents per class.

    The documents with the smallest id hashes are taken; ties go to the smaller id. The ids are
    picked first, so only sampled texts are shuffled.
    """
    graded = labels.select(F.col("doc_id").alias("id"), grade.cast("int").alias("grade")).dropna()
    graded = graded.groupBy("id").agg(F.max("grade").alias("grade"))
    graded = graded.join(docs.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
    counts = {r["grade"]: r["count"] for r in graded.groupBy("grade").count().collect()}
    picked = None
    for value in sorted(counts):
        part = graded.filter(F.col("grade") == value).orderBy(F.xxhash64("id"), "id").limit(size)
        part = part.withColumn("weight", F.lit(max(1.0, counts[value] / size)))
        picked = part if picked is None else picked.union(part)
    if picked is None:
        picked = graded.withColumn("weight", F.lit(1.0))
    picked = settle(picked, "sample")
    texts = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("id"))
    return texts.select("doc_id", "text", "grade", "weight")


def feature_rows(sample: DataFrame) -> DataFrame:
    """doc_id, grade, weight and the arrays features and counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            found = [counted(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("grade"), part.column("weight"),
                    pa.array([list(f) for f in found], pa.list_(pa.int64())),
                    pa.array([list(f.values()) for f in found], pa.list_(pa.int64())),
                ],
                names=["doc_id", "grade", "weight", "features", "counts"],
            )

    schema = "doc_id long, grade int, weight double, features array<long>, counts array<long>"
    return sample.mapInArrow(rows, schema)


def choose_features(rows: DataFrame, number: int = FEATURES) -> dict[int, float]:
    """The features that tell grade 0 from the others best, with their log odds ratios.

    Features are ranked by the z-score of the difference of their document shares.
    """
    toxic = F.col("grade") > 0
    totals = rows.agg(F.sum(toxic.cast("long")), F.sum((~toxic).cast("long"))).first()
    bad, good = totals[0] or 0, totals[1] or 0
    if not bad or not good:
        return {}
    counts = rows.select(F.explode("features").alias("feature"), toxic.cast("long").alias("toxic")).groupBy("feature")
    counts = counts.agg(F.count("*").alias("docs"), F.sum("toxic").alias("bad"))
    share_bad, share_good = F.col("bad") / bad, (F.col("docs") - F.col("bad")) / good
    share = F.col("docs") / (bad + good)
    z = F.abs(share_bad - share_good) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / bad + 1 / good))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("docs") - F.col("bad") + 0.5) / (good + 1))
    best = counts.filter(F.col("docs") >= LEAST_DOCS).select("feature", odds.alias("odds"), z.alias("z"))
    return {r["feature"]: r["odds"] for r in best.filter("z > 4").orderBy(F.desc("z"), "feature").limit(number).collect()}


def fit(rows: list[tuple[dict[int, int], int, float]], features: list[int], steps: int = 300) -> OrdinalModel:
    """Weighted maximum likelihood of the cumulative-link model by Adam, with a small ridge.

    The gaps between thresholds are exponentials of free numbers, which keeps them in order.
    """
    place = {f: k for k, f in enumerate(features)}
    grades = np.array([g for _, g, _ in rows])
    weight = np.array([w for _, _, w in rows])
    weight = weight / weight.sum()
    pairs = [(r, place[f], capped(n)) for r, (x, _, _) in enumerate(rows) for f, n in x.items() if f in place]
    row, column, value = (np.array(v) for v in zip(*pairs)) if pairs else (np.zeros(0, int),) * 3
    cuts = int(grades.max())
    theta = np.zeros(len(features) + cuts)
    theta[len(features)] = 1.0
    moment, square = np.zeros_like(theta), np.zeros_like(theta)

    def thresholds() -> np.ndarray:
        free = theta[len(features) :]
        return free[0] + np.r_[0, np.cumsum(np.exp(free[1:]))]

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    for step in range(1, steps + 1):
        score = np.bincount(row, weights=theta[column] * value, minlength=len(rows))
        edges = np.r_[-np.inf, thresholds(), np.inf]
        low, high = sigmoid(edges[grades] - score), sigmoid(edges[grades + 1] - score)
        slope_low, slope_high = low * (1 - low), high * (1 - high)
        gain = weight / np.maximum(high - low, 1e-12)
        d_score = gain * (slope_high - slope_low)
        d_edge = np.zeros(cuts)
        for k in range(cuts):
            d_edge[k] = (gain * slope_low)[grades == k + 1].sum() - (gain * slope_high)[grades == k].sum()
        gradient = np.zeros_like(theta)
        gradient[: len(features)] = np.bincount(column, weights=d_score[row] * value, minlength=len(features))
        gradient[: len(features)] += 1e-5 * theta[: len(features)]
        gradient[len(features)] = d_edge.sum()
        for k in range(1, cuts):
            gradient[len(features) + k] = d_edge[k:].sum() * np.exp(theta[len(features) + k])
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta -= 0.05 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return OrdinalModel({f: float(theta[k]) for f, k in place.items()}, [float(x) for x in thresholds()])


def train(docs: DataFrame, labels: DataFrame, grade: Column, binary: bool = False, size: int = SAMPLE) -> OrdinalModel | None:
    """Fit on the sample; ``binary`` grades (0, 1) are split into severities 0, 1 and 2."""
    rows = settle(feature_rows(labelled_sample(docs, labels, grade, size)), "features")
    odds = choose_features(rows)
    chosen = sorted(odds)
    shared = docs.sparkSession.sparkContext.broadcast(set(chosen))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                {f: n for f, n in zip(fs, ns) if f in shared.value}
                for fs, ns in zip(batch.column("features").to_pylist(), batch.column("counts").to_pylist())
            ]
            columns = [pa.array([list(x) for x in found], pa.list_(pa.int64()))]
            columns.append(pa.array([list(x.values()) for x in found], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), batch.column("weight"), *columns], names=["grade", "weight", "features", "counts"]
            )

    local = []
    short = rows.select("grade", "weight", "features", "counts")
    for r in short.mapInArrow(narrow, short.schema).toLocalIterator():
        x = dict(zip(r["features"], r["counts"]))
        value = r["grade"]
        if binary and value:
            value = 1 + (sum(n for f, n in x.items() if odds[f] > 3) >= SEVERE)
        local.append((x, value, r["weight"]))
    grades = sorted({g for _, g, _ in local})
    if len(grades) < 2:
        return None
    return fit([(x, grades.index(g), w) for x, g, w in local], chosen)


SCORED = "doc_id long, severity double, grade int, p_toxic double"


def scorer(model: OrdinalModel | None):
    """Texts to (expected severity, likeliest grade, P(grade > 0))."""
    seen: dict[str, tuple[int, ...]] = {}
    weights = model.weights if model else {}

    def known_features(word: str) -> tuple[int, ...]:
        if len(seen) > CACHE:
            seen.clear()
        seen[word] = found = tuple(f for f in features_of(word) if f in weights)
        return found

    def total(text: str) -> float:
        counts: dict[int, int] = {}
        for word, n in Counter(WORD.findall(text)).items():
            found = seen.get(word)
            for f in known_features(word) if found is None else found:
                counts[f] = counts.get(f, 0) + n
        return sum(weights[f] * capped(n) for f, n in sorted(counts.items()))

    def score(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if model is None:
            zero = np.zeros(len(texts))
            return zero, zero.astype(np.int32), zero
        totals = np.array([total(t or "") for t in texts])
        below = model.at_most(totals)
        chances = np.diff(np.c_[np.zeros(len(texts)), below, np.ones(len(texts))], axis=1)
        grades = np.arange(chances.shape[1])
        return chances @ grades, chances.argmax(axis=1).astype(np.int32), 1 - below[:, 0]

    return score


def severity(docs: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """doc_id, severity (expected grade), grade and p_toxic of every row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(shared.value)
        for part in pieces(batches):
            expected, grade, p = score(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(expected), pa.array(grade), pa.array(p)],
                names=["doc_id", "severity", "grade", "p_toxic"],
            )

    return docs.select("doc_id", "text").mapInArrow(scored, SCORED)


def without_toxic(docs: DataFrame, model: OrdinalModel | None, limit: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that are less likely than ``limit`` to be toxic, columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(shared.value)
        for part in pieces(batches):
            _, _, p = score(part.column("text").to_pylist())
            yield part.filter(pa.array(p < limit))

    return docs.mapInArrow(keep, docs.schema)
