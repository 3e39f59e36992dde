"""Versioned model folders `<name>_v<k>` and their metadata rows."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .files import claim, list_names, remove_folder


class ModelNotFoundError(LookupError):
    """No such model version."""


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Versions present, ascending."""
    pattern = re.compile(re.escape(name) + r"_v(\d+)$")
    found = (pattern.match(n) for n in list_names(spark, root))
    return sorted(int(m.group(1)) for m in found if m)


def next_version(spark: SparkSession, root: str, name: str) -> int:
    present = versions(spark, root, name)
    return present[-1] + 1 if present else 1


def version_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/{name}_v{version}"


def resolve(spark: SparkSession, root: str, name: str, version: str | int = "latest") -> int:
    """`latest`, `v3`, `3` or 3 as a number; the version must exist."""
    present = versions(spark, root, name)
    if version == "latest":
        if not present:
            raise ModelNotFoundError(name)
        return present[-1]
    number = int(str(version).lstrip("v"))
    if number not in present:
        raise ModelNotFoundError(f"{name}_v{number}")
    return number


def save_model(spark: SparkSession, model: PipelineModel, root: str, name: str) -> int:
    """Save under the next version. Of two writers that meet in a version, the later one moves on."""
    for _ in range(100):
        version = next_version(spark, root, name)
        if claim(spark, version_path(root, name, version)):
            model.write().overwrite().save(version_path(root, name, version))
            return version
    raise OSError(f"no free version of {name}")


def load_model(spark: SparkSession, root: str, name: str, version: str | int = "latest") -> PipelineModel:
    return PipelineModel.load(version_path(root, name, resolve(spark, root, name, version)))


def outdated(spark: SparkSession, root: str, name: str, current: int | None = None) -> list[str]:
    """Folders of versions before the current one. Nothing is removed here."""
    present = versions(spark, root, name)
    current = current if current is not None else (present[-1] if present else 0)
    return [version_path(root, name, v) for v in present if v < current]


def prune(spark: SparkSession, root: str, name: str, current: int | None = None, dry_run: bool = True) -> list[str]:
    """Folders of versions before the current one, removed unless `dry_run` (the default)."""
    folders = outdated(spark, root, name, current)
    if not dry_run:
        for folder in folders:
            remove_folder(spark, folder)
    return folders


def metadata_row(
    spark: SparkSession, name: str, version: int, metrics: dict, params: dict, at: datetime | None = None
) -> DataFrame:
    """One registry row; append it to the registry table."""
    return spark.createDataFrame(
        [(name, version, {k: float(v) for k, v in metrics.items()}, {k: str(v) for k, v in params.items()},
          at or datetime.now(timezone.utc))],
        "name string, version int, metrics map<string,double>, params map<string,string>, created_at timestamp",
    )


def latest_rows(registry: DataFrame) -> DataFrame:
    """The newest row of each model."""
    return registry.groupBy("name").agg({"version": "max"}).withColumnRenamed("max(version)", "version").join(
        registry, ["name", "version"]
    )
