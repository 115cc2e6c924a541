"""Target weights, repetition and seeded draws."""

import random

import odd
import pytest

from fareflow.llm import mixture


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight; what a source cannot take is shared anew among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_} if open_ else {}
        above = {s for s in open_ if share[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else share[s] for s in names}
        full |= above


@pytest.mark.parametrize("seed", range(3))
def test_targets_equal_the_plain_ones(spark, seed):
    rng = random.Random(seed)
    sizes = {rng.choice("abcdefghij") + str(k): int(10 ** rng.uniform(0, 5)) for k in range(rng.randint(1, 12))} | {None: 7}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixture.source_targets(rows).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s])


def test_odd_rows_are_mixed(spark):
    docs = odd.odd_documents(spark)
    rows = {(r["doc_id"], r["size"]) for r in mixture.copies_per_document(docs).collect()}
    assert {(1, 0), (2, 0), (3, 0), (4, 1), (5, 60_000), (None, 3), (7, 4), (9, 1), (10, 1)} <= rows
    assert mixture.copies_per_document(docs).count() == len(odd.ODD)
    mixed = mixture.mix(docs)
    assert mixed.columns == docs.columns
    copies = {(r["doc_id"], r["source"], r["copies"]) for r in mixture.copies_per_document(docs).collect()}
    counts = {}
    for r in mixed.collect():
        counts[r["doc_id"], r["source"]] = counts.get((r["doc_id"], r["source"]), 0) + 1
    for doc_id, source, n in copies:
        times = sum(d == doc_id and s == source for d, _, _, s in odd.ODD)
        assert counts.get((doc_id, source), 0) == n * times


def test_nothing_to_mix(spark):
    assert mixture.copies_per_document(odd.no_documents(spark)).count() == 0
    assert mixture.mix(odd.no_documents(spark)).count() == 0
    empty = odd.documents(spark, [(1, None), (2, "")])
    assert [(r["size"], r["target"], r["copies"]) for r in mixture.copies_per_document(empty).collect()] == [(0, 0.0, 0)] * 2


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    texts = [(k, "w " * (1 + k % 7), "en", f"s{k % 4}" if k % 3 else "hot") for k in range(6000)]
    docs = odd.documents(spark, texts)
    rows = mixture.copies_per_document(docs).collect()
    taken, target = {}, {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    for s in target:
        assert taken[s] == pytest.approx(target[s], rel=0.08)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixture.copies_per_document(docs.repartition(5)).collect()))
