"""Fingerprints, links and components against all pairs."""

import random

import numpy as np
import odd
import plain
import pytest

from fareflow.llm import simhash
from fareflow.llm.components import components


def test_fingerprint_equals_the_plain_one():
    rng = random.Random(2)
    texts = ["", " ", "One", "one two THREE", "Ünïcode ÀB c d e", *(" ".join(rng.choices("a B c ç 漢 dd".split(), k=n)) for n in range(1, 60))]
    for text in texts:
        assert simhash.fingerprint(text.encode()) == plain.fingerprint(text)


def test_chunks_do_not_change_a_fingerprint(monkeypatch):
    text = odd.LONG[:3000].encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole


def near_fingerprints(rng, clusters, size):
    out = set()
    for _ in range(clusters):
        mark = rng.getrandbits(64)
        for _ in range(size):
            out.add(mark)
            for b in rng.sample(range(64), rng.randint(0, 4)):
                mark ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 5])
@pytest.mark.parametrize("size", [3, 90])
def test_links_connect_what_is_near(spark, bucket, size):
    marks = near_fingerprints(random.Random(size), 240 // size, size) + [0, 1, 3]
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    classes = spark.createDataFrame([(m,) for m in signed], "fingerprint long")
    links = simhash.linked(classes, bucket=bucket)
    for r in links.collect():
        assert ((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 4
    root = {r["node"]: r["root"] for r in components(links).collect()}
    want = plain.components([(s, m) for s, m in zip(signed, marks)], lambda a, b: (a ^ b).bit_count() <= 4)
    assert [root.get(s, s) for s in signed] == want


def test_more_fingerprints_make_finer_buckets():
    assert len(simhash.bit_ranges(1000, 4)) == 15
    masks = simhash.bit_ranges(1 << 27, 4)
    assert min(m.bit_count() for m in masks) >= 26
    rng = random.Random(0)
    for _ in range(200):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not flips & m for m in masks)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5), (7, 3), (3, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 1000 for k in range(1000, 1100)}, 7: 3, 3: 3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    texts = [*odd.ODD, (11, "some text that is repeated here"), (12, "some text that is repeated here"), (11, "some text that is repeated here")]
    rows = simhash.digest(simhash.near_duplicates(odd.documents(spark, texts))).collect()
    keys = [(t[0] if t[0] is not None else 10**9, plain.fingerprint(t[1])) for t in texts]
    want = plain.components(keys, lambda a, b: (a ^ b).bit_count() <= 4)
    expected = sorted((t[0] or 0, f"{k[1]:016x}", None if c == 10**9 else c) for t, k, c in zip(texts, keys, want))
    assert sorted((r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in rows) == expected
    assert simhash.near_duplicates(odd.no_documents(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    same, other = "some text that is repeated here", "quite different words in this one"
    docs = odd.documents(spark, [(2, same), (2, same), (9, same), (2, other), (5, other), (7, "alone it stands and stays"), (None, None)])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [
        (0, ""), (2, other), (2, same), (7, "alone it stands and stays")
    ]


def test_pair_table_discards_only_far_pairs():
    rng = np.random.default_rng(0)
    marks = rng.integers(0, 2**64, size=500, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, size=k % 7, replace=False)) for k in range(500)], dtype=np.uint64)
    table, moved = (simhash.distance_table(m, simhash.pivots(24)) for m in (marks, marks ^ flips))
    kept = simhash.verified(marks, marks ^ flips, table, moved, 4)
    assert kept.tolist() == [k for k in range(500) if k % 7 <= 4]
