"""Training-corpus pipeline: language, repeated lines, near-copies, benchmark leaks, tokens.

Every stage takes all documents its predecessor kept. The result of each is written as Parquet below the shared folder and read back, so a
lost executor never makes an earlier stage run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import language, leaks, lines, nearcopies, tokens
from ledgerlens.llm.common import table
from ledgerlens.llm.queries import vocabulary
from ledgerlens.session import scratch_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or below the calibrated threshold go."""
    model = language.train_language_model(docs)
    return language.identify(docs, model).filter("NOT rejected").select(*docs.columns)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of two or more lines that stand earlier in the corpus; a document of which nothing is left goes."""
    out = lines.drop_repeated_passages(docs).filter("n_removed_lines = 0 OR trim(text) <> ''")
    counted = {"n_chars": F.when(F.col("n_removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return out.withColumns(counted).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies (five-word shingles, similarity 0.8 or more)."""
    gone = nearcopies.near_copies(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"), min_words=1).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their count and the digest of the decoded text."""
    return tokens.encode_documents(docs, vocabulary(), ("n_tokens", "ids", "decoded_sha256")).select("doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("language_id", known_language), ("line_dedup", fresh_lines), ("near_dedup", one_of_each),
    ("decontamination", without_benchmark), ("bpe", encoded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
