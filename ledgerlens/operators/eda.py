"""Exploratory reports: class balance, descriptive statistics, risk tables, skewness, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .ordered import running_totals
from .skew import DEFAULT_POLICY, SkewPolicy


def class_balance(df: DataFrame, target: str = "isFraud") -> DataFrame:
    """Rows per class."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("rows"))


def positive_rate(df: DataFrame, target: str = "isFraud", by=()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.avg(target).alias("positive_rate"))


def describe_by(
    df: DataFrame, by: str, col: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per group.

    Quartiles interpolate linearly. They come from running counts over distinct values, so no
    task collects a group.
    """
    policy = policy.settled(df)
    known = df.where(F.col(col).isNotNull() & F.col(by).isNotNull())
    # one read: everything else follows from the distinct values, their counts and squared distances
    values = materialise(known.groupBy(by, F.col(col).alias("__v")).agg(F.count(F.lit(1)).alias("__n")))
    basic = values.groupBy(by).agg(
        F.sum("__n").alias("count"), F.expr("sum(__v * __n) / sum(__n)").alias("mean"),
        F.min("__v").alias("min"), F.max("__v").alias("max"),
    )
    spread = values.join(basic.select(by, "mean", "count"), by).groupBy(by).agg(
        F.expr("CASE WHEN max(count) > 1 THEN sqrt(sum(__n * power(__v - mean, 2)) / (max(count) - 1)) END").alias("std")
    )
    ranked = running_totals(values, ["__v"], {"__upto": "__n"}, [by], policy)
    sized = ranked.join(basic.select(by, F.col("count").alias("__all")), by)
    picks = []
    for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        at = f"((__all - 1) * {q}D)"
        low = f"min(CASE WHEN __upto > floor({at}) THEN __v END)"
        high = f"min(CASE WHEN __upto > ceil({at}) THEN __v END)"
        part = f"(max({at}) - floor(max({at})))"
        picks.append(F.expr(f"{low} + ({high} - {low}) * {part}").alias(name))
    return basic.join(spread, by).join(sized.groupBy(by).agg(*picks), by).select(
        by, "count", "mean", "std", "min", "max", "q25", "q50", "q75"
    )


def risk_table(df: DataFrame, keys: list[str], target: str = "isFraud") -> DataFrame:
    """Fraud rate, volume and frauds per key; rows missing a key are left out."""
    return df.dropna(subset=keys).groupBy(*keys).agg(
        F.avg(target).alias("fraud_rate"),
        F.count(target).alias("volume"),
        F.sum(target).cast("bigint").alias("frauds"),
    )


def riskiest(df: DataFrame, keys: list[str], target: str = "isFraud", top: int | None = None) -> DataFrame:
    """Risk table by frauds, most first; ties break on the keys."""
    ordered = risk_table(df, keys, target).orderBy(F.desc("frauds"), *keys)
    return ordered.limit(top) if top else ordered


def absolute_skewness(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Bias-corrected absolute skewness of numeric columns as rows `(column, skewness)`."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    one = df.agg(
        *[
            F.expr(
                f"abs(skewness(`{c}`) * CASE WHEN count(`{c}`) > 2 THEN sqrt(count(`{c}`) * (count(`{c}`) - 1D))"
                f" / (count(`{c}`) - 2) END)"
            ).alias(f"__s{i}")
            for i, c in enumerate(cols)
        ]
    )
    pairs = ", ".join(f"struct('{c}' AS column, __s{i} AS skewness)" for i, c in enumerate(cols))
    return one.selectExpr(f"explode(array({pairs})) AS p").select("p.*")


def top_groups(df: DataFrame, group: str, value: str, k: int = 3, per: str | None = None) -> DataFrame:
    """The `k` groups with the largest sum of `value`, at each `per` if given."""
    keys = [per, group] if per else [group]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("total"))
    if per is None:
        return sums.orderBy(F.desc("total"), group).limit(k)
    w = Window.partitionBy(per).orderBy(F.desc("total"), group)
    return sums.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
