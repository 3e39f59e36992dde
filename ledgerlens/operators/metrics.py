"""Evaluation of scored rows: confusion counts, rates, ROC-AUC, average precision, KS distance."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import running_totals
from .skew import DEFAULT_POLICY, SkewPolicy


def with_prediction(df: DataFrame, score: str, threshold: float = 0.5, name: str = "pred") -> DataFrame:
    return df.withColumn(name, (F.col(score) > F.lit(threshold)).cast("int"))


def confusion_counts(df: DataFrame, label: str, pred: str, by=()) -> DataFrame:
    """True/false negatives and positives, per group if asked."""
    def cell(want_label: int, want_pred: int, name: str):
        return F.expr(f"sum(CAST({label} = {want_label} AND {pred} = {want_pred} AS BIGINT))").alias(name)

    return df.groupBy(*by).agg(
        cell(0, 0, "true_negatives"), cell(0, 1, "false_positives"),
        cell(1, 0, "false_negatives"), cell(1, 1, "true_positives"),
    )


# Zero denominators count as 0.
_RATES = {
    "accuracy": "coalesce(try_divide(true_positives + true_negatives,"
                " true_positives + true_negatives + false_positives + false_negatives), 0D)",
    "precision": "coalesce(try_divide(true_positives, true_positives + false_positives), 0D)",
    "recall": "coalesce(try_divide(true_positives, true_positives + false_negatives), 0D)",
    "f1_score": "coalesce(try_divide(2 * true_positives, 2 * true_positives + false_positives + false_negatives), 0D)",
}


def classification_rates(confusion: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 beside the counts."""
    return confusion.selectExpr("*", *[f"{sql} AS {name}" for name, sql in _RATES.items()])


def ranking_quality(
    df: DataFrame, label: str, score: str, by=(), policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """ROC-AUC (ties count half) and average precision.

    Rows are first reduced to one per distinct score; only that table is ordered. Groups with
    one class only have no AUC.
    """
    policy = policy.settled(df)
    by = list(by)
    scores = df.groupBy(*by, (-F.col(score)).alias("__down")).agg(
        F.sum(label).alias("__pos"), F.sum(1 - F.col(label)).alias("__neg")
    )
    ranked = running_totals(scores, ["__down"], {"__tp": "__pos", "__fp": "__neg"}, by, policy)
    return ranked.groupBy(*by).agg(
        F.expr(
            "try_divide(sum(__neg * (__tp - __pos / 2D)), CAST(sum(__pos) AS DOUBLE) * sum(__neg))"
        ).alias("roc_auc"),
        F.expr("try_divide(sum(__pos * (__tp / (__tp + __fp))), sum(__pos))").alias("average_precision"),
    )


def evaluate(
    df: DataFrame, label: str, pred: str, score: str, by=(), policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """The full metric row (per group if asked; rows without a group are one)."""
    by = list(by)
    rates = classification_rates(confusion_counts(df, label, pred, by))
    ranks = ranking_quality(df, label, score, by, policy)
    if by:
        named = ranks.withColumnsRenamed({c: f"__{c}" for c in by})
        same = reduce(and_, (rates[c].eqNullSafe(named[f"__{c}"]) for c in by))
        return rates.join(named, same).drop(*[f"__{c}" for c in by])
    one = F.lit(1)
    return rates.withColumn("__one", one).join(ranks.withColumn("__one", one), "__one").drop("__one")


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    cells = df.groupBy(F.col(label).alias("l"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    parts = cells.selectExpr(
        "explode(array(struct(l AS class, IF(l = p, n, 0L) AS tp, n AS support, 0L AS predicted),"
        " struct(p AS class, 0L AS tp, 0L AS support, n AS predicted))) AS s"
    ).select("s.*")
    classes = parts.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted")
    ).selectExpr(
        "CAST(class AS STRING) AS class",
        "coalesce(try_divide(tp, predicted), 0D) AS precision",
        "coalesce(try_divide(tp, support), 0D) AS recall",
        "coalesce(try_divide(2 * tp, support + predicted), 0D) AS f1_score",
        "support",
    )
    names = ("precision", "recall", "f1_score")
    macro = classes.agg(*[F.avg(n).alias(n) for n in names], F.sum("support").alias("support"))
    weighted = classes.agg(
        *[F.try_divide(F.sum(F.col(n) * F.col("support")), F.sum("support")).alias(n) for n in names],
        F.sum("support").alias("support"),
    )
    return (
        classes.unionByName(macro.withColumn("class", F.lit("macro avg")))
        .unionByName(weighted.withColumn("class", F.lit("weighted avg")))
    )


def ks_distance(
    first: DataFrame, second: DataFrame, col: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Largest gap between the two empirical distributions of `col` (one row, `ks`)."""
    pool = first.select(F.col(col).alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        second.select(F.col(col).alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    values = pool.where("v IS NOT NULL").groupBy("v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    steps = running_totals(values, ["v"], {"ca": "a", "cb": "b"}, policy=policy)
    return steps.sparkSession.sql(
        "SELECT max(abs(ca / (SELECT sum(a) FROM {values}) - cb / (SELECT sum(b) FROM {values}))) AS ks"
        " FROM {steps}",
        steps=steps, values=values,
    )


def batch_summary(df: DataFrame, pred: str) -> DataFrame:
    """Rows, frauds and fraud rate in percent, rounded to two digits; 0 for an empty batch."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(pred), F.lit(0)).cast("bigint").alias("fraud_count"),
        F.round(F.coalesce(F.avg(pred) * 100, F.lit(0.0)), 2).alias("fraud_rate"),
    )


def mean_confidence(df: DataFrame, pred: str, prob: str) -> DataFrame:
    """Mean probability of the predicted class."""
    return df.agg(F.avg(F.when(F.col(pred) == 1, F.col(prob)).otherwise(1 - F.col(prob))).alias("avg_confidence"))


def bucket_histogram(df: DataFrame, col: str, edges, by=()) -> DataFrame:
    """Cumulative counts `value <= edge` per edge and for +Inf, as rows `(le, n)`."""
    names = [str(float(e)) for e in edges] + ["+Inf"]
    counts = [f"sum(CAST({col} <= {float(e)}D AS BIGINT))" for e in edges] + [f"count({col})"]
    wide = df.groupBy(*by).agg(*[F.expr(c).alias(f"__b{i}") for i, c in enumerate(counts)])
    pairs = ", ".join(f"struct('{n}' AS le, __b{i} AS n)" for i, n in enumerate(names))
    return wide.selectExpr(*by, f"explode(array({pairs})) AS b").selectExpr(*by, "b.le", "b.n")


def request_summary(log: DataFrame, latency: str = "latency_s", status: str = "status", sec: str = "sec") -> DataFrame:
    """Requests, successes, errors, mean and largest latency, and requests per second."""
    return log.agg(
        F.count(F.lit(1)).alias("requests"),
        F.expr(f"count_if({status} = 200)").alias("successes"),
        F.expr(f"count_if({status} <> 200)").alias("errors"),
        F.avg(latency).alias("avg_latency"),
        F.max(latency).alias("max_latency"),
        F.expr(f"try_divide(count(1), max({sec}) - min({sec}))").alias("requests_per_s"),
    )
