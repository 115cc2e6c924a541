"""Near copies against all pairs of texts."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import odd
import plain
import pytest

from fareflow.llm import near_copies as nc
from fareflow.llm.texts import table


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_bit_sets_meet_pairs_as_often_as_said():
    for n in (1000, 10**5):
        masks = nc.bit_sets(n)
        rng = np.random.default_rng(1)
        met = 0
        for _ in range(2000):
            flip = np.uint64(sum(1 << int(b) for b in rng.choice(64, nc.AIM, replace=False)))
            met += bool(((masks & flip) == 0).any())
        assert met / 2000 > nc.FOUND - 0.04


def test_groups_of_edited_texts(spark):
    rng = random.Random(2)
    texts = {}
    for group in range(60):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((60, 150, 400)))]
        for _ in range(rng.choice((1, 2, 4))):
            texts[len(texts)] = " ".join(edited(rng, base, rng.choice((0, 0, 1, len(base) // 60))))
    sets = {k: shingles(t) for k, t in texts.items()}
    keys = list(texts)
    want = plain.components([(k, sets[k]) for k in keys], similar)
    kept = {r.doc_id for r in nc.one_of_each(odd.documents(spark, list(texts.items()))).collect()}
    assert kept >= set(want)  # nothing goes that has no near copy
    assert len(kept - set(want)) <= 0.05 * (len(keys) - len(set(want)))
    assert len(set(want)) < 0.7 * len(keys)


def test_recall_on_the_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    sets = {k: shingles(t) for k, t in rows.items()}
    near = [(a, b) for a, b in combinations(sorted(rows), 2) if similar(sets[a], sets[b])]
    roots = dict(zip(rows, plain.components([(k, k) for k in rows], lambda a, b, p=set(near): (a, b) in p or (b, a) in p)))
    kept = {r.doc_id for r in nc.one_of_each(docs).collect()}
    assert kept >= set(roots.values())
    apart = [(a, b) for a, b in near if rows[a].lower().split() != rows[b].lower().split()]
    missed = [(a, b) for a, b in apart if b in kept]
    assert len(apart) >= 10 and len(missed) <= 0.1 * len(apart)


@pytest.mark.parametrize("bucket", [nc.BUCKET, 3])
def test_many_near_copies_are_one_group(spark, bucket, monkeypatch):
    monkeypatch.setattr(nc.candidates, "__defaults__", (nc.DISTANCE, bucket))
    rng = random.Random(3)
    base = [f"w{k}" for k in range(300)]
    docs = [(k, " ".join(edited(rng, base, 1))) for k in range(200)] + [(500 + k, f"text number {k} of its own {k * k}") for k in range(20)]
    kept = sorted(r.doc_id for r in nc.one_of_each(odd.documents(spark, docs)).collect())
    assert kept[0] == 0 and kept[-20:] == list(range(500, 520)) and len(kept) <= 23


def test_copies_whose_first_candidates_fail_are_found(spark, monkeypatch):
    """All fingerprints meet in all buckets; the partners of few bits that are kept are not similar, others are."""
    rng = random.Random(8)
    monkeypatch.setattr(nc, "class_pairs", lambda marked, real=nc.class_pairs: real(marked.withColumn("fingerprint", nc.F.pmod("ref", nc.F.lit(4)))))
    texts = {}
    for group in range(40):
        base = [f"w{rng.randrange(3000)}" for _ in range(100)]
        for n in range(2):
            texts[2 * group + n] = " ".join(base[:-1] + [f"end{n}"])
    kept = {r.doc_id for r in nc.one_of_each(odd.documents(spark, list(texts.items()))).collect()}
    assert kept == set(range(0, 80, 2))


def test_odd_rows(spark):
    docs = odd.odd_documents(spark)
    kept = nc.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    want = sorted([(0, "no id here"), (1, ""), (4, "word")] + [(i, t) for i, t, *_ in odd.ODD if i in (5, 7, 9, 10)])
    assert got == want
    assert nc.one_of_each(odd.no_documents(spark)).count() == 0
    rows = [(None, "the same words"), (None, "the same words"), (3, "The same  words"), (3, "other"), (3, "other"), (3, "another one")]
    assert sorted((r.doc_id, r.text) for r in nc.one_of_each(odd.documents(spark, rows)).collect()) == [
        (3, "The same  words"), (3, "another one"), (3, "other")
    ]


def test_sketches_leave_out_no_link_and_most_others():
    rng = np.random.default_rng(8)
    base = [rng.choice(2**31, size=int(n), replace=False).astype(np.int32) for n in rng.integers(1, 400, 40)] + [np.zeros(0, dtype=np.int32)]
    base.append((np.arange(2 * nc.FULL) * nc.CELLS).astype(np.int32))
    sets = [np.unique(np.r_[s[: max(1, int(len(s) * part))], rng.choice(2**31, size=int(len(s) * more))]).astype(np.int32)
            for s in base for part, more in ((1, 0), (0.95, 0.04), (0.9, 0.1), (0.85, 0.05), (0.6, 0.4), (0.5, 0.5))]
    sizes = np.array([len(s) for s in sets])
    cells = nc.cells_of(pa.array([nc.sketch(s) for s in sets]))
    x, y = np.triu_indices(len(sets), 1)
    kept = nc.able((sizes[x], sizes[y]), (cells[x], cells[y]), nc.SIMILAR)
    common = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y)])
    links = common >= nc.SIMILAR * (sizes[x] + sizes[y] - common)
    assert links.sum() > 100 and kept[links].all()
    assert kept.sum() < links.sum() + 0.05 * len(x)


def test_pairs_of_a_crowded_bucket_that_cannot_be_links_are_not_made(spark, tmp_path):
    words = [f"w{k}" for k in range(400)]
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(words, 60)) for _ in range(60)]
    texts += [f"{t} more" for t in texts[:20]]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    marked = nc.settle(nc.classes_of(docs, nc.WIDTH).withColumn("fingerprint", nc.F.col("ref") % 8), "marked")
    pairs, classes, open_ = nc.class_pairs(marked)
    none = classes.limit(0).select("ref", nc.F.col("ref").alias("root"))
    left = nc.pairs_left(open_, classes, none, pairs.limit(0), distance=64)
    found = {frozenset(r) for r in left.union(nc.possible(pairs, classes, nc.SIMILAR)).collect()}
    refs = [nc.text_class(nc.words_of(t.encode())) for t in texts]
    own = [set(nc.shingle_set(nc.words_of(t.encode())).tolist()) for t in texts]
    met = {frozenset((refs[k], refs[60 + k])) for k in range(20) if len(own[k] & own[60 + k]) >= nc.SIMILAR * len(own[k] | own[60 + k])}
    assert len(met) == 20 and len(found) < 40
    _, roots = nc.near_copies(docs)
    assert roots.count() == 40


def test_candidates_of_a_large_group_are_two_per_fingerprint(spark):
    rng = random.Random(11)
    marks = {sum(1 << k for k in rng.sample(range(63), 5)) for _ in range(2000)}
    rows = [(k, mark, 0, bytes(nc.CELLS)) for k, mark in enumerate(sorted(marks))]
    marked = spark.createDataFrame(rows, "ref long, fingerprint long, size int, sketch binary")
    pairs, _, open_ = nc.class_pairs(marked)
    assert len(marks) // 2 <= pairs.count() <= 2 * len(marks)
    assert open_.select("fingerprint").distinct().count() >= 0.95 * len(marks)


def test_pairs_that_are_not_kept_are_compared_later(spark):
    rows = [(0, 1), (0, 3), (0, 2), (1, 3), (2, 3), (3, 11), (1, 2), (-1, -2)]
    met = spark.createDataFrame([(a, b, None, b != 11) for a, b in rows], "a long, b long, bucket long, alone boolean")
    kept, beside = ({tuple(r) for r in df.collect()} for df in nc.kept_pairs(met))
    assert kept == {(0, 1), (0, 2), (0, 3), (1, 3), (3, 11), (-2, -1)} and beside == {(1, 2), (2, 3)}


def test_classes_of_a_bucket_have_two_pairs_at_most_before_all_pairs(spark):
    texts = [" ".join(f"w{j}" for j in range(100)) + f" end{k}" for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = nc.settle(nc.classes_of(docs, nc.WIDTH), "marked")
    classes = marked.select("ref", "fingerprint", "size", "sketch")
    open_ = classes.select(nc.F.lit(1).cast("long").alias("bucket"), "fingerprint").distinct()
    none = classes.limit(0)
    roots, done = none.select("ref", nc.F.col("ref").alias("root")), none.select(nc.F.col("ref").alias("a"), nc.F.col("ref").alias("b"))
    few = {tuple(r) for r in nc.pairs_left(open_, classes, roots, done, distance=64, few=True).collect()}
    every = {tuple(r) for r in nc.pairs_left(open_, classes, roots, done, distance=64).collect()}
    assert few < every and len(few) <= 60 and len(every) == 30 * 29 // 2
    assert {x for pair in few for x in pair} == {x for pair in every for x in pair}
