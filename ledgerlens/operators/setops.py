"""Unions of training and scoring rows, and column-set comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both frames by column name; absent columns become null."""
    return first.unionByName(second, allowMissingColumns=True)


def joint_features(
    train: DataFrame, test: DataFrame, build: Callable[[DataFrame], DataFrame], marker: str = "is_train"
) -> tuple[DataFrame, DataFrame]:
    """Compute features over both sets together and hand them back apart."""
    both = stack_rows(train.withColumn(marker, F.lit(1)), test.withColumn(marker, F.lit(0)))
    done = build(both)
    return (
        done.where(F.col(marker) == 1).drop(marker),
        done.where(F.col(marker) == 0).drop(marker),
    )


def column_difference(first: DataFrame, second: DataFrame) -> dict[str, list[str]]:
    """Columns only in the first, only in the second, and in both."""
    a, b = first.columns, second.columns
    return {
        "only_first": [c for c in a if c not in b],
        "only_second": [c for c in b if c not in a],
        "both": [c for c in a if c in b],
    }
