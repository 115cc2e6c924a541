"""Encoded lengths and their suffix sums."""

import odd
import pytest

from fareflow.llm import token_lengths as tl


@pytest.fixture(scope="module")
def tokenizer():
    return tl.encoding(tl.read_vocabulary())


def test_long_texts_are_cut_where_the_pattern_cuts(tokenizer):
    text = ("It's 12 words,\n\n  and more… don't  stop ünïcode 漢字 9a a9 " * 4000).strip()
    assert tl.encoded_length(tokenizer, text) == len(tokenizer.encode_ordinary(text))


def test_runs_that_the_pattern_does_not_cut(tokenizer, monkeypatch):
    runs = [" " * 70_001 + "b", "a" * 70_000, "1" * 70_000, "!?" * 35_000, "\n" * 70_000, "\t \n" * 30_000 + " x", "a b" + " " * 70_000 + "c's 9\n"]
    for text in runs:
        whole = len(tokenizer.encode_ordinary(text))
        monkeypatch.setattr(tl, "PART", 1 << 10)
        assert tl.encoded_length(tokenizer, text) == whole
        assert tl.encoded_length(tokenizer, "some words " + text + " and more") == len(tokenizer.encode_ordinary("some words " + text + " and more"))


def test_runs_of_five_megabytes(spark, tokenizer):
    n = 5_000_000
    texts = [" " * n + "b", "\n" * n + "x", "a" * n, "1" * n, "!" * n]
    lengths = [tl.encoded_length(tokenizer, t) for t in texts]
    assert lengths[0] == n and all(0 < k <= n for k in lengths)
    docs = odd.documents(spark, list(enumerate(texts[:2])))
    assert {(r["length"], r["docs"]) for r in tl.length_counts(docs).collect()} == {(k, 1) for k in lengths[:2]}


def test_histogram_answers_limits_and_quantiles(spark, tokenizer):
    texts = [*odd.ODD[:8], *((30 + k, "some words here " * (k % 5)) for k in range(40))]
    docs = odd.documents(spark, texts)
    lengths = sorted(len(tokenizer.encode_ordinary(t[1] or "")) for t in texts)
    rows = tl.suffix_sums(tl.length_counts(docs), block=7).collect()
    assert sorted(r["length"] for r in rows) == sorted(set(lengths))
    for r in rows:
        above = [n for n in lengths if n >= r["length"]]
        assert (r["docs"], r["docs_from"], r["tokens_from"]) == (lengths.count(r["length"]), len(above), sum(above))
        assert r["truncated_tokens"] == sum(min(n, r["length"]) for n in lengths)
        assert r["share"] == pytest.approx(sum(n <= r["length"] for n in lengths) / len(lengths))
    histogram = tl.length_histogram(docs)
    cut = {r["limit"]: (r["docs_cut"], r["truncated_tokens"]) for r in tl.at_limits(histogram, [0, 5, 100, 10**6]).collect()}
    assert cut == {c: (sum(n > c for n in lengths), sum(min(n, c) for n in lengths)) for c in cut}
    got = {r["share"]: r["length"] for r in tl.quantiles(histogram, [0.5, 0.9, 1.0]).collect()}
    assert got == {s: next(n for n in lengths if sum(x <= n for x in lengths) >= s * len(lengths)) for s in got}


def test_no_documents(spark):
    assert tl.length_histogram(odd.no_documents(spark)).count() == 0


def test_a_large_vocabulary_is_refused(monkeypatch):
    monkeypatch.setattr(tl, "VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError, match="larger"):
        tl.read_vocabulary()
