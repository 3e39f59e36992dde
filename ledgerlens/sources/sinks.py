"""Writers for tables, predictions and metric rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, file_format: str = "parquet", mode: str = "overwrite", partition_by=()) -> None:
    """Parquet by default; csv carries a header."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_format == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(file_format).save(path)


def with_day(df: DataFrame, time_col: str = "TransactionDT", name: str = "day") -> DataFrame:
    """Day number of the time offset: the partition column of transaction tables."""
    return df.withColumn(name, F.floor(F.col(time_col) / 86400).cast("int"))


def export_predictions(df: DataFrame, path: str, id_col: str = "TransactionID", pred: str = "prediction_isFraud") -> None:
    """`TransactionID,isFraud` as csv."""
    write_table(df.select(id_col, F.col(pred).alias("isFraud")), path, "csv")


def metric_rows(spark: SparkSession, values: dict[str, float], labels: dict[str, str] | None = None, at: datetime | None = None) -> DataFrame:
    """Named numbers as rows `(ts, name, labels, value)`."""
    at = at or datetime.now(timezone.utc)
    return spark.createDataFrame(
        [(at, n, labels or {}, float(v)) for n, v in values.items()],
        "ts timestamp, name string, labels map<string,string>, value double",
    )


def append_metrics(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def evaluation_summary(train: dict, test: dict) -> dict[str, float]:
    """The nine numbers kept per training run."""
    kept = ("roc_auc", "f1_score", "precision", "recall")
    out = {f"train_{k}": float(train.get(k) or 0.0) for k in kept}
    out.update({f"test_{k}": float(test.get(k) or 0.0) for k in (*kept, "accuracy")})
    return out


def training_run_rows(
    spark: SparkSession, duration_s: float, status: int, rows: int, metrics: dict[str, float],
    labels: dict[str, str] | None = None, at: datetime | None = None,
) -> DataFrame:
    """Metric rows of one training run, with the number of rows really used."""
    values = {"training_duration_seconds": duration_s, "training_status": status, "training_data_rows": rows}
    names = {
        "accuracy": "model_accuracy", "precision": "model_precision", "recall": "model_recall",
        "f1_score": "model_f1_score", "roc_auc": "model_auc_roc",
    }
    values.update({out: metrics[k] for k, out in names.items() if k in metrics})
    return metric_rows(spark, values, labels, at)
