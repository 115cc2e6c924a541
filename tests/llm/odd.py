"""Rows that every operator must bear: nulls, empty and very long texts, repeats, clashing columns."""

from pyspark.sql import DataFrame, SparkSession

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
LONG = " ".join(f"{WORDS[i * i % 12]}{i % 97}" for i in range(60_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, rank int, fingerprint string, "
    "id long, n long, spans string, row string, key long, words string, component_id long, target double, `of` string"
)
CLASH = (1, 2, "x", 3, 4, "y", "z", 5, "w", 6, 7.0, "v")


def rows(texts):
    """(doc_id, text) or (doc_id, text, lang, source) to full rows."""
    out = []
    for row in texts:
        doc_id, text, lang, source = (*row, "en", "s1")[:4] if len(row) == 2 else row
        out.append((doc_id, text, lang, source, len(text or ""), *CLASH))
    return out


def documents(spark: SparkSession, texts) -> DataFrame:
    return spark.createDataFrame(rows(texts), SCHEMA)


ODD = [
    (1, None, "en", "s1"), (2, "", "en", None), (3, " \t\n", None, "s1"), (4, "word", "en", "s2"), (4, "word", "en", "s2"),
    (5, LONG, "de", "s1"), (None, "no id here", "en", "s2"), (7, "Ünïcode 漢字 😀 text", "fr", "s3"), (8, "WORD", "en", "s1"),
    (9, "a" * 300_000, "en", "s1"), (10, "1" * 50_000, "en", "s1"),
]


def odd_documents(spark: SparkSession) -> DataFrame:
    return documents(spark, ODD)


def no_documents(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
