"""Fixtures of the text operators' tests."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and columns named like results."""
    long = " ".join(f"w{i % 977}x{i % 131}" for i in range(30_000))
    rows = [
        (1, "The cat sat on the mat and looked at the moon all night long.\nSecond line here.", "en", 5),
        (1, "The cat sat on the mat and looked at the moon all night long.\nSecond line here.", "en", 5),
        (2, None, None, None), (3, "", "en", 0), (None, "a text without an id that is long enough to count here", None, 1), (4, "12345 67 !!", "en", 2),
        (5, long, "en", 3), (6, long + " end", "fr", 3), (7, "Ünïcödé ΑΣ 日本語 😀 <|endoftext|> x", None, 4), (8, "   \n\t \n", "en", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").selectExpr(
        "doc_id", "text", "lang", "'src' AS source", "CAST(length(text) AS BIGINT) AS n_chars", "score", "'x' AS n_removed", "'y' AS features"
    )


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.limit(0)
