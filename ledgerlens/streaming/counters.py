"""Cumulative counters of requests, errors and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import trim_batches

LABELS = {
    "inference_requests_total": ("method", "endpoint", "status"),
    "inference_errors_total": ("error_type",),
    "model_predictions_total": ("result",),
}


def counter(log: DataFrame, labels, name: str = "count") -> DataFrame:
    """Rows per combination of labels; the same call works on a stream. Rows without a label
    (a request without an error) do not count."""
    return log.dropna(subset=list(labels)).groupBy(*labels).agg(F.count(F.lit(1)).alias(name))


def prediction_results(log: DataFrame, pred: str = "pred") -> DataFrame:
    return log.withColumn("result", F.when(F.col(pred) == 1, "fraud").otherwise("legitimate"))


def keep_counter(
    stream: DataFrame, labels, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Maintain a counter table from a stream: after every batch its folder holds all counts, and
    the folders of the last two batches stay."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        trim_batches(batch.sparkSession, path, batch_id)

    writer = (
        counter(stream, labels).writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint).foreachBatch(store)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
