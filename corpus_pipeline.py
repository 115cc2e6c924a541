"""A corpus pipeline: documents in, the mixture to train on out.

Every stage takes the documents its predecessor kept and returns rows of the same columns; each
result is written and read again, so a lost executor never recomputes more than one stage.

Rows: null and empty texts pass the filters and are near-duplicates of each other; very long texts are read whole;
of rows that share an id each is decided by its own text; of equal rows one stays; an empty table gives an
empty one; columns beside those of documents pass through, whatever their names.
"""

from pyspark.sql import DataFrame, SparkSession

from fareflow.llm import contamination, mixture, near_copies, queries, secret_scan, toxicity
from fareflow.llm.texts import table
from fareflow.workspace import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go; it learns from the labelled ones among ``docs``."""
    return toxicity.without_toxic(docs, queries.toxicity_model(spark, docs, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    SimHash finds the candidates; documents are linked if their five-word shingles are similar to 0.8 or more.
    """
    return near_copies.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return contamination.without_contamination(docs, table(spark, sf_dir, "benchmark"))


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text holds a secret go."""
    return secret_scan.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weight of its source says."""
    return mixture.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("contamination", drop_contaminated),
    ("secrets", drop_secrets),
    ("mixture", mix_sources),
]

#: SQL cannot express the fitted model and the fingerprints; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
