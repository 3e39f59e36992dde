"""Rates, latency quantiles and alert rules over logs and metric series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LATENCY_BUCKETS
from ..functions.sqltext import add
from ..operators.ordered import ordered_features
from ..operators.skew import DEFAULT_POLICY, SkewPolicy


@dataclass(frozen=True)
class Rule:
    """Fires once `condition` on `value` has held for `hold_seconds`."""

    name: str
    metric: str
    condition: str
    hold_seconds: int
    severity: str


# The alert rules and their limits.
RULES = (
    Rule("HighCPUUsage", "cpu_used_percent", "value > 80", 300, "warning"),
    Rule("HighMemoryUsage", "memory_used_percent", "value > 85", 300, "warning"),
    Rule("DiskSpaceLow", "disk_free_percent", "value < 10", 300, "critical"),
    Rule("HighLatency", "latency_p99", "value > 2", 120, "warning"),
    Rule("HighErrorRate", "error_rate", "value > 0.05", 120, "critical"),
    Rule("ServiceDown", "up", "value = 0", 60, "critical"),
    Rule("AbnormalFraudRate", "fraud_rate_percent", "abs(value - 3.5) > 5", 600, "warning"),
    Rule("LowModelConfidence", "model_confidence_score", "value < 0.7", 300, "warning"),
    Rule("TrainingJobFailed", "training_status", "value = 0", 60, "critical"),
    Rule("ModelPerformanceDegraded", "model_auc_roc", "value < 0.85", 60, "warning"),
)
RULES_BY_NAME = {r.name: r for r in RULES}


def window_start(ts: str, width: str, slide: str | None = None) -> Column:
    return F.window(ts, width, slide) if slide else F.window(ts, width)


def sliding_rate(
    log: DataFrame, by=(), ts: str = "ts", width_s: int = 300, slide_s: int = 60, watermark: str | None = None
) -> DataFrame:
    """Events per second in windows of `width_s` seconds every `slide_s` seconds. On a stream,
    give a watermark so finished windows leave the state."""
    if watermark:
        log = log.withWatermark(ts, watermark)
    w = window_start(ts, f"{width_s} seconds", f"{slide_s} seconds")
    counted = log.groupBy(*by, w.alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return counted.select(
        *by, F.unix_timestamp("w.start").alias("window_start"), "events",
        (F.col("events") / F.lit(float(width_s))).alias("per_second"),
    )


def error_rate(log: DataFrame, ts: str = "ts", width_s: int = 300, status: str = "status", limit: float = 0.05) -> DataFrame:
    """Share of failed requests per window and whether it passes the limit."""
    w = window_start(ts, f"{width_s} seconds")
    counted = log.groupBy(w.alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), F.expr(f"count_if({status} >= 500)").alias("errors")
    )
    return counted.selectExpr(
        "unix_timestamp(w.start) AS window_start", "requests", "errors",
        "errors / CAST(requests AS DOUBLE) AS error_rate",
        f"CAST(errors / CAST(requests AS DOUBLE) > {limit}D AS INT) AS alert",
    )


def latency_quantile(
    log: DataFrame, q: float = 0.99, latency: str = "latency_s", ts: str = "ts", width_s: int = 300,
    edges=LATENCY_BUCKETS, limit: float = 2.0,
) -> DataFrame:
    """Quantile per window from cumulative buckets, linear inside a bucket. Beyond the last
    bucket it is the last edge."""
    w = window_start(ts, f"{width_s} seconds")
    counts = ", ".join([f"sum(CAST({latency} <= {float(e)}D AS BIGINT))" for e in edges] + [f"count({latency})"])
    hist = log.groupBy(w.alias("w")).agg(F.expr(f"array({counts})").alias("upto"))
    n = len(edges)
    edge_array = "array(" + ", ".join(f"{float(e)}D" for e in edges) + ")"
    hist = hist.selectExpr(
        "unix_timestamp(w.start) AS window_start", "upto", f"upto[{n}] AS requests", f"{float(q)}D * upto[{n}] AS rank"
    ).where("requests > 0")
    hist = hist.selectExpr("*", "CAST(array_position(transform(upto, c -> c >= rank), true) AS INT) AS b")
    # Array subscripts must stay inside, whichever branch is taken.
    hist = hist.selectExpr("window_start", "requests", "rank", "upto", f"least(b, {n}) AS b", f"b > {n} AS beyond")
    low = f"coalesce(try_element_at({edge_array}, nullif(b - 1, 0)), 0D)"
    below = "coalesce(try_element_at(upto, nullif(b - 1, 0)), 0L)"
    inside = f"{low} + ({edge_array}[b - 1] - {low}) * (rank - {below}) / (upto[b - 1] - {below})"
    return hist.selectExpr(
        "window_start", "requests", f"IF(beyond, {float(edges[-1])}D, {inside}) AS quantile"
    ).selectExpr("*", f"CAST(quantile > {limit}D AS INT) AS alert")


def counter_increase(
    series: DataFrame, key: str, order=("sec",), value: str = "value", policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Increase of a counter since its previous sample; a drop means it restarted from 0."""
    before = f"lag({value}) OVER ({{w}})"
    rise = f"CASE WHEN {before} IS NULL THEN NULL WHEN {value} < {before} THEN {value} ELSE {value} - {before} END"
    return ordered_features(series, key, list(order), {"increase": rise}, policy=policy.settled(series))


def sustained(
    series: DataFrame, key: str, condition: str, hold_seconds: int, order=("sec",), sec: str = "sec",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Mark samples where the condition holds (`breach`) and has held without a break for
    `hold_seconds` (`firing`), per series."""
    marked = add(series, {"breach": f"CAST(coalesce({condition}, false) AS INT)"})
    started = f"CASE WHEN breach = 1 AND coalesce(lag(breach) OVER ({{w}}), 0) = 0 THEN {sec} END"
    runs = ordered_features(
        marked, key, list(order), {"__started": started}, {"run_start": "__started"}, policy=policy.settled(series)
    )
    return add(
        runs,
        {
            "run_start": "CASE WHEN breach = 1 THEN run_start END",
            "firing": f"CAST(breach = 1 AND {sec} - run_start >= {hold_seconds} AS INT)",
        },
        drop=("__started",),
    )


def apply_rule(series: DataFrame, rule: Rule, key: str = "series", **options) -> DataFrame:
    """Evaluate one rule on `(series, sec, value)` samples."""
    return add(sustained(series, key, rule.condition, rule.hold_seconds, **options), {"alert": f"'{rule.name}'"})


def quality_series(log: DataFrame, every_s: int = 3600) -> DataFrame:
    """Fraud rate and mean confidence of a prediction log as gauge samples."""
    slot = f"sec DIV {every_s} * {every_s}"
    gauges = log.groupBy(F.expr(slot).alias("sec")).agg(
        (F.avg("pred") * 100).alias("fraud_rate_percent"),
        F.expr("avg(IF(pred = 1, prob, 1 - prob))").alias("model_confidence_score"),
    )
    return gauges.selectExpr(
        "sec",
        "inline(array(struct('fraud_rate_percent' AS series, fraud_rate_percent AS value),"
        " struct('model_confidence_score' AS series, model_confidence_score AS value)))",
    )
