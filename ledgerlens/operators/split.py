"""Reproducible splits. A row's side depends on its key only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, read_once
from .skew import DEFAULT_POLICY, SkewPolicy, lookup

_BUCKETS = 100_000


def hash_bucket(key: str, seed: int, buckets: int = _BUCKETS) -> Column:
    """Bucket of a key from the leading 60 bits of a digest, so that any engine can repeat it. All
    missing keys fall into one bucket."""
    digest = f"substr(md5(concat('{int(seed)}:', coalesce(CAST(`{key}` AS STRING), 'null'))), 1, 15)"
    return F.expr(f"pmod(CAST(conv({digest}, 16, 10) AS BIGINT), {int(buckets)})")


def split_by(df: DataFrame, in_test: Column) -> tuple[DataFrame, DataFrame]:
    """`(train, test)` by a condition on the row."""
    return df.where(~in_test), df.where(in_test)


def stratified_split(
    df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 6,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> tuple[DataFrame, DataFrame]:
    """`(train, test)` with the same class shares in both.

    Each class is cut where its running count over hash buckets reaches the wanted share. The
    counts have at most 100,000 rows per class however large the data is. Rows without a label
    are a class of their own; rows without a key stay together on one side.
    """
    df = read_once(df)  # for the counts and for both sides
    df = df.withColumn("__class", F.coalesce(F.col(label).cast("string"), F.lit("\0")))
    counts = df.groupBy("__class", hash_bucket(key, seed).alias("__b")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    cut = materialise(counts.selectExpr(
        "__class", "__b",
        "sum(__n) OVER (PARTITION BY __class ORDER BY __b) AS __upto",
        "sum(__n) OVER (PARTITION BY __class) AS __all",
    ).groupBy("__class").agg(
        F.expr(f"coalesce(max(CASE WHEN __upto <= round(__all * {test_size}D) THEN __b END), -1)").alias("__cut")
    ))
    classes = cut.count()
    marked = lookup(df.withColumn("__b", hash_bucket(key, seed)), cut, "__class", policy, classes)
    train, test = split_by(marked, F.col("__b") <= F.col("__cut"))
    return train.drop("__b", "__cut", "__class"), test.drop("__b", "__cut", "__class")


def shares_split(df: DataFrame, key: str, shares, seed: int = 6) -> list[DataFrame]:
    """Parts with about the given shares, not stratified."""
    total, parts, low = float(sum(shares)), [], 0
    bucket = hash_bucket(key, seed)
    for i, share in enumerate(shares):
        high = _BUCKETS if i == len(shares) - 1 else low + round(_BUCKETS * share / total)
        parts.append(df.where((bucket >= low) & (bucket < high)))
        low = high
    return parts


def split_summary(df: DataFrame, split: str, label: str) -> DataFrame:
    """Rows and positive share per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"), F.avg(label).alias("positive_rate"))
