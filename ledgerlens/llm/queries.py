"""The registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, language, leaks, licenses, lines, nearcopies, pages, periodic, repeats, shards, tokens, toxicity, whitening
from .common import table

VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def fold(parts: int) -> Column:
    """Remainder of the id's checksum."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents"), depth=200)


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op3_language_identification(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.train_language_model(docs, fold(3) != 1)
    held = docs.select("doc_id", "text", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"))
    return language.identify(held, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op4_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, folder, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"), min_words=1)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"), factors=lines.FACTORS).select(
        "doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"), licenses.notices(spark))


def op8_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tokens.encode_documents(docs, vocabulary(), ("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train_toxicity(docs.filter(fold(4) != 2), table(spark, folder, "labels"))
    held = docs.select("doc_id", "text", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"))
    return toxicity.score_toxicity(held, model)


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return nearcopies.near_copies(table(spark, folder, "documents"), size=3, percent=85)


def op11_balanced_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.shard_texts(table(spark, folder, "documents"), keep=("doc_id",), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit_whitening(vectors, components=8, scale=1024.0, offset=100_000)
    shares = F.array(*[F.lit(float(v)) for v in model.explained]).cast("array<double>")
    rows = whitening.whiten(vectors, model).select("vec_id", "n", F.col("deviation").try_cast("bigint").alias("deviation"), F.posexplode("whitened").alias("k", "whitened"))
    return rows.select(
        "vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", "whitened", F.get(shares, F.col("k")).alias("explained"),
        F.lit(whitening.identity_error(vectors, model)).alias("identity_error"),
    )


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Each whole text, one in ten of them made periodic from a word on, with its runs and what is left of it."""
    words = r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"
    again = "transform(ws, (w, i) -> IF(i < a, w, ws[a + (i - a) % p]))"
    period = "CAST(1 + (size(ws) - a) DIV (3 + g % 8) AS INT)"
    # one-element arrays bind a value once: a plain column used inside a lambda would be computed for each element
    bound = (
        f"transform(array({words}), ws -> IF(size(ws) = 0, '', transform(array(CAST(g % size(ws) AS INT)), a -> "
        f"transform(array({period}), p -> array_join({again}, ' '))[0])[0]))[0]"
    )
    docs = table(spark, folder, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h")).selectExpr("*", "h DIV 10 AS g")
    made = docs.selectExpr("doc_id", f"CASE WHEN h % 10 = 0 AND text IS NOT NULL THEN {bound} ELSE text END AS text")
    best = "reduce(runs, element_at(runs, 1), (b, r) -> IF(r.length * b.period > b.length * r.period, r, b))"
    found = periodic.collapse_runs(made, least=6, exponent=4).selectExpr(
        "doc_id", "CAST(size(runs) AS BIGINT) AS n_runs", f"CASE WHEN size(runs) > 0 THEN {best} END AS best",
        "sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), ''), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )
    return found.selectExpr("doc_id", "n_runs", "best.start", "best.length", "best.period", "1000 * best.length DIV best.period AS exponent_milli", "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_html_extraction, op3_language_identification, op4_document_fingerprints, op5_benchmark_decontamination,
    op6_line_dedup, op7_license_scan, op8_bpe_encoding, op9_toxicity, op10_minhash_near_dedup, op11_balanced_shards, op12_embedding_whitening, op13_periodic_runs,
)}
ORACLE = {"op6_line_dedup": lines.ORACLE, "op13_periodic_runs": periodic.ORACLE}
