"""Session helpers: a tuned builder, the shared scratch folder and durable materialisation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDER: dict[str, str] = {}


def build_session(name: str = "ledgerlens", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume: UTC, AQE with skew splitting, ANSI."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`).

    Only when the session names none, and only in local mode, a temporary folder is made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDER:
        _OWN_FOLDER[app] = tempfile.mkdtemp(prefix="ledgerlens-")
    return _OWN_FOLDER[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write the rows below the shared folder and read them back.

    This cuts the lineage, so a lost executor cannot change the rows, and the scan that follows
    knows its size and prunes columns.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_once(df: DataFrame) -> DataFrame:
    """Rows that will be read more than once: a frame made from several tables is stored, a scan of one is left alone."""
    return df if df._jdf.queryExecution().analyzed().collectLeaves().size() == 1 else materialise(df)
