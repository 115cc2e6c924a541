"""The index, its search and the removal spans."""

import random

import numpy as np
import odd
import plain
import pytest
from pyspark.sql import functions as F

from fareflow.llm import contamination as c


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_every_occurrence(seed):
    rng = np.random.default_rng(seed)
    symbols = np.r_[rng.integers(1, 3 + seed * 3, size=300), 0].astype(np.int64)
    order = c.suffix_order(symbols)
    assert order.tolist() == sorted(range(301), key=lambda i: symbols[i:].tolist())
    index = c.ShardIndex(symbols, sample=4)
    lengths = rng.integers(1, 6, size=60)
    starts = rng.integers(0, 290, size=60)
    windows = np.zeros((60, 6), dtype=np.int64)
    for k, (s, n) in enumerate(zip(starts, lengths)):
        windows[k, :n] = symbols[s : s + n] if k % 3 else rng.integers(1, 14, size=n)
    low, high = index.search(windows, lengths)
    for k, n in enumerate(lengths):
        want = [i for i in range(301 - n) if (symbols[i : i + n] == windows[k, :n]).all()]
        assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == want


def passages(rng, n):
    vocabulary = [f"w{k}" for k in range(30)] + ["the", "Of", "é9"]
    return [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) for _ in range(n)]


def check(spark, docs, items, **options):
    frame = odd.documents(spark, docs)
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    found = c.digest(c.find_contamination(frame, benchmark, **options))
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in found.collect())
    want = sorted(
        (d[0] or 0, n, hit, len(names), plain.digest(",".join(names)), hit > 0)
        for d, (n, hit, names) in zip(docs, plain.contamination([d[1] for d in docs], items))
    )
    assert got == want
    clean = c.without_contamination(frame, benchmark, **options)
    assert clean.columns == frame.columns
    assert sorted(r["doc_id"] or 0 for r in clean.collect()) == sorted(w[0] for w in want if not w[5])


def test_odd_documents_and_items(spark):
    rng = random.Random(4)
    items = [(k, t) for k, t in enumerate(passages(rng, 25))]
    items += [(100, None), (101, ""), (102, "word"), (None, "some unnamed item of more than ten words in all it has"), (3, items[5][1])]
    docs = [*odd.ODD]
    for k, text in enumerate(passages(rng, 40)):
        docs.append((50 + k, f"{text} {items[k % 25][1].upper()}, {text}-{items[(k + 1) % 25][1][:40]}", "en", "s1"))
    check(spark, docs, items)


def test_blocks_of_the_benchmark_give_the_same(spark):
    rng = random.Random(9)
    items = [(k, t) for k, t in enumerate(passages(rng, 25))]
    docs = [(k, f"{a} {items[k % 25][1]} {b}") for k, (a, b) in enumerate(zip(passages(rng, 30), passages(rng, 30)))]
    check(spark, docs, items, block_bytes=500)


def test_nothing_to_search(spark):
    check(spark, odd.ODD, [])
    check(spark, [], [(1, "one two")])
    check(spark, odd.ODD, [(1, "not there at all in any of them " * 3)])
