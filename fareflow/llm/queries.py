"""The queries of this subpackage: each applies its operator to the whole given table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import (
    alignment,
    contamination,
    language,
    mixture,
    passages,
    pii,
    secret_scan,
    sharding,
    simhash,
    token_lengths,
    topk,
    toxicity,
    whitening,
)
from fareflow.llm.oracle import ORACLE_SQL  # noqa: F401
from fareflow.llm.texts import table


def op1_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_private(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.filter(~language.held_out(F.col("doc_id"))))
    return language.predict(docs, model).withColumn("held_out", language.held_out(F.col("doc_id")))


def op3_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths.length_histogram(table(spark, sf_dir, "documents"))


def op4_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixture.copies_per_document(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.OrdinalModel | None:
    return toxicity.train(docs, table(spark, sf_dir, "labels"), F.col("toxic"), binary=True)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.severity(docs, toxicity_model(spark, docs, sf_dir))
    return scored.withColumn("toxic", F.col("p_toxic") >= toxicity.REJECT)


def op10_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return contamination.digest(found)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_private_data, op2_language, op3_token_lengths, op4_source_mixture, op5_top_k, op6_simhash, op7_secret_scan,
        op8_repeated_passages, op9_toxicity,
        op10_contamination, op11_whitening, op12_token_alignment, op13_sharding, pipeline,
    )
}
