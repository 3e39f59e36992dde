"""Drift of recent predictions against a reference sample and a baseline rate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.metrics import ks_distance
from ..operators.ordered import ordered_features
from ..operators.skew import DEFAULT_POLICY, SkewPolicy
from ..sources.files import list_names, trim_batches

WINDOW_ROWS = 1000
MINIMUM_ROWS = 100
BASELINE_RATE = 0.035
KS_LIMIT = 0.3
LABEL_LIMIT = 0.05
_PARTS = 256


def reference_sample(spark: SparkSession, n: int = 1000, tail: float = 28.0) -> DataFrame:
    """Evenly spaced quantiles of the low-score distribution `Beta(1, tail)`."""
    return spark.range(1, n + 1).selectExpr(f"1 - power(1 - (id - 0.5D) / {float(n)}D, 1 / {float(tail)}D) AS prob")


def recent_rows(log: DataFrame, n: int = WINDOW_ROWS, by: str | None = None, order=("sec", "seq")) -> DataFrame:
    """The last `n` rows, overall or per key.

    A key may hold most of the log: its rows are first dealt to parts by a hash of the order
    columns, each part keeps its own last `n`, and only those meet in one task.
    """
    latest = [F.desc(c) for c in order]
    if by is None:
        return log.orderBy(*latest).limit(n)
    part = F.pmod(F.xxhash64(*order), F.lit(_PARTS))
    dealt = log.withColumn("__part", part)
    for keys in ([by, "__part"], [by]):
        w = Window.partitionBy(*keys).orderBy(*latest)
        dealt = dealt.withColumn("__place", F.row_number().over(w)).where(F.col("__place") <= n).drop("__place")
    return dealt.drop("__part")


def rolling_rates(
    log: DataFrame, key: str = "model_version", n: int = WINDOW_ROWS, order=("sec", "seq"),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """For every prediction: rows and alert share of the `n` latest up to it, per model."""
    upto = "OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    # A running sum minus the one `n` rows earlier: no frame is summed again for every row.
    out = ordered_features(
        log, key, list(order),
        [
            {"__sum": f"sum(CAST(prob > 0.5D AS INT)) {upto}", "__row": "row_number() OVER ({w})"},
            {
                "rows_in_window": f"least(__row, {n})",
                "rate_in_window": f"(__sum - coalesce(lag(__sum, {n}) OVER ({{w}}), 0)) / least(__row, {n})",
            },
        ],
        history=n - 1, policy=policy.settled(log),
    )
    return out.drop("__sum", "__row")


def label_drift(window: DataFrame, prob: str = "prob", baseline: float = BASELINE_RATE) -> DataFrame:
    """Distance of the alert share from the baseline; 0 below the minimum number of rows."""
    return window.agg(
        F.expr(
            f"IF(count({prob}) < {MINIMUM_ROWS}, 0D, abs(avg(CAST({prob} > 0.5D AS INT)) - {baseline}D))"
        ).alias("label_drift"),
        F.count(prob).alias("samples_in_window"),
    )


def drift_report(window: DataFrame, reference: DataFrame, prob: str = "prob") -> DataFrame:
    """One row: both drifts, both alerts, rows in the window, and whether a check is due."""
    ks = ks_distance(reference, window, prob)
    both = window.sparkSession.sql(
        "SELECT coalesce((SELECT ks FROM {ks}), 0D) AS ks, * FROM {label}", ks=ks, label=label_drift(window, prob)
    )
    return both.selectExpr(
        f"IF(samples_in_window < {MINIMUM_ROWS}, 0D, ks) AS prediction_drift",
        "label_drift", "samples_in_window",
    ).selectExpr(
        "prediction_drift", f"CAST(prediction_drift > {KS_LIMIT}D AS INT) AS prediction_drift_alert",
        "label_drift", f"CAST(label_drift > {LABEL_LIMIT}D AS INT) AS label_drift_alert",
        "samples_in_window", "CAST(samples_in_window % 100 = 0 AS INT) AS check_due",
    )


def _latest_state(spark: SparkSession, root: str, before: int) -> DataFrame | None:
    done = [int(n.split("=")[1]) for n in list_names(spark, root) if n.startswith("batch=")]
    done = [b for b in done if b < before]
    return spark.read.parquet(f"{root}/batch={max(done)}") if done else None


def window_batch(
    batch: DataFrame, batch_id: int, state_root: str, n: int = WINDOW_ROWS, key: str = "model_version",
    order=("sec", "seq"),
) -> DataFrame:
    """Fold one micro-batch into the last-`n` window per model.

    The state of each batch is its own folder: a repeated batch rewrites the same folder from
    the same input, so a restart neither loses nor doubles rows. The last two folders stay.
    """
    spark = batch.sparkSession
    previous = _latest_state(spark, state_root, batch_id)
    pool = batch if previous is None else batch.unionByName(previous)
    recent_rows(pool, n, key, order).write.mode("overwrite").parquet(f"{state_root}/batch={batch_id}")
    trim_batches(spark, state_root, batch_id)
    return spark.read.parquet(f"{state_root}/batch={batch_id}")


def watch_predictions(
    stream: DataFrame, state_root: str, checkpoint: str, on_window: Callable[[DataFrame, int], None] | None = None,
    n: int = WINDOW_ROWS, key: str = "model_version", available_now: bool = False,
) -> StreamingQuery:
    """Keep the last-`n` window of a prediction stream and hand it over after every batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        window = window_batch(batch, batch_id, state_root, n, key)
        if on_window:
            on_window(window, batch_id)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
