"""Language spans: best paths, scripts, mixed texts, held-out accuracy."""

from itertools import product

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from fareflow.llm import language
from fareflow.llm.queries import op2_language


def test_best_paths_equal_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(100):
        lengths = rng.integers(0, 6, size=rng.integers(1, 6))
        scores = (rng.normal(size=(int(lengths.sum()), 3)) * 3).astype(np.float32)
        ends = np.cumsum(lengths)
        path = language.best_paths(scores, ends - lengths, ends, 2.0)
        for a, b in zip(ends - lengths, ends):
            value = lambda p: sum(scores[a + i, x] for i, x in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: E731,B023
            if b > a:
                assert value(path[a:b]) == pytest.approx(max(map(value, product(range(3), repeat=int(b - a)))), abs=1e-3)


def test_paths_between_sure_words_are_best():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lengths = rng.integers(0, 40, size=rng.integers(1, 6))
        scores = (rng.normal(size=(int(lengths.sum()), 3)) * rng.choice([2, 6])).astype(np.float32)
        of = np.r_[0, np.cumsum(lengths)]
        whole, cut = language.best_paths(scores, of[:-1], of[1:], 2.0), language.sure_paths(scores, of, 2.0)
        for a, b in zip(of[:-1], of[1:]):
            value = lambda p: scores[np.arange(a, b), p[a:b]].sum() - 2.0 * (np.diff(p[a:b]) != 0).sum()  # noqa: E731,B023
            assert value(cut) == pytest.approx(value(whole), abs=1e-3)


def test_a_million_words(model):
    import time

    text = f"{EN} {DE} {RU} " * 50_000
    start = time.perf_counter()
    _, _, path, _, letters = language.label([text], model)
    assert len(path) == 50_000 * len(f"{EN} {DE} {RU}".split()) and letters.sum() > 10**6
    assert time.perf_counter() - start < 20


EN, DE, RU = "the thing and that with other them", "der schöne ist nicht einer für auch", "это что как все они был"


@pytest.fixture(scope="module")
def model(spark):
    return language.learn(odd.documents(spark, [(1, EN, "en", ""), (2, DE, "de", ""), (3, RU, "ru", ""), (4, None, "xx", ""), (5, EN, None, "")]))


def test_model_counts_everything_known(model):
    assert model.languages == ["de", "en", "ru"]
    assert model.uses[language.script_of(np.array([ord("д")]))[0]].tolist() == [False, False, True]


def test_mixed_text_has_spans(spark, model):
    text = f"{EN}. {DE}! {RU} {EN}"
    docs = odd.documents(spark, [(9, text), (10, None), (11, "12 — 34")])
    spans = [tuple(r) for r in language.language_spans(docs, model, switch=3.0).orderBy("start").collect()]
    assert [s[3] for s in spans] == ["en", "de", "ru", "en"]
    assert [text[s[1] : s[2]] for s in spans] == [EN, DE, RU, EN]


def test_odd_rows(spark, model):
    rows = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(odd.odd_documents(spark), model).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (10, "und", 0.0)} <= rows
    assert all(0 <= s <= 1 for _, _, s in rows)
    assert language.predict(odd.odd_documents(spark), model).count() == len(odd.ODD)
    assert language.predict(odd.no_documents(spark), model).count() == 0


def test_nothing_learned(spark):
    nothing = language.learn(odd.no_documents(spark))
    assert {r["lang_pred"] for r in language.predict(odd.odd_documents(spark), nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = op2_language(spark, sf_dir).join(truth, "doc_id")
    right = rows.filter("held_out and lang_pred <> 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
