"""The stages in order, each against a plain version of its decision."""

import odd
import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fareflow.llm import mixture, queries, secret_scan, toxicity
from fareflow.llm.texts import table

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark):
    """Rows before and after every stage."""
    docs = table(spark, SF_DIR, "documents")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema)
        out.append(docs.collect())
    return out


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_names_and_columns(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "contamination", "secrets", "mixture"]
    for rows in results:
        assert list(rows[0].asDict()) == COLUMNS


def test_toxicity_stage(spark, results):
    docs = spark.createDataFrame(results[0], ", ".join(f"{c} {t}" for c, t in zip(COLUMNS, ["long", "string", "string", "string", "long"])))
    model = queries.toxicity_model(spark, docs, SF_DIR)
    kept = {r["doc_id"] for r in toxicity.severity(docs, model).filter(F.col("p_toxic") < toxicity.REJECT).collect()}
    assert ids(results[1]) == sorted(kept)


def test_near_duplicate_stage(results):
    """Five words, similarity 0.8, by brute force over whole texts; of near copies nine in ten are found."""
    def shingles(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    keys = [(r["doc_id"], shingles(r["text"])) for r in results[1]]
    want = set(plain.components(keys, lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)))
    kept = set(ids(results[2]))
    assert kept >= want and len(kept - want) <= 0.1 * (len(keys) - len(want))


def test_contamination_stage(spark, results):
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    hits = plain.contamination([r["text"] for r in results[2]], items)
    assert ids(results[3]) == sorted(r["doc_id"] for r, (_, hit, _) in zip(results[2], hits) if not hit)


def test_secret_stage(spark, results):
    clean = {r["doc_id"] for r in results[3] if not plain.secrets(r["text"])}
    kept = set(ids(results[4]))
    assert kept <= clean
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in results[3]], "doc_id long, text string")
    found = secret_scan.digest(secret_scan.find_secrets(docs)).collect()
    assert clean - kept == {r["doc_id"] for r in found if r["n_random"] and r["doc_id"] in clean}


def test_mixture_stage(spark, results):
    docs = spark.createDataFrame([tuple(r) for r in results[4]], "doc_id long, text string, lang string, source string, n_chars long")
    copies = {r["doc_id"]: r["copies"] for r in mixture.copies_per_document(docs).collect()}
    assert ids(results[5]) == sorted(k for k, n in copies.items() for _ in range(n))


def test_run_gives_the_last_stage(spark, results):
    assert ids(corpus_pipeline.run(spark, SF_DIR).collect()) == ids(results[5])


def test_stages_bear_odd_and_no_rows(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.odd_documents(spark), SF_DIR).columns == odd.odd_documents(spark).columns
        assert stage(spark, odd.odd_documents(spark), SF_DIR).count() > 0
        assert stage(spark, odd.no_documents(spark), SF_DIR).count() == 0
