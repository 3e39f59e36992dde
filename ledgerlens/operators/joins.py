"""Transaction-identity join, match report and static lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import lit, map_of
from .skew import DEFAULT_POLICY, SkewPolicy, hashed, lookup


class DuplicateKeyError(ValueError):
    """The dimension side of a one-to-one join holds a key twice."""


def merge_identity(
    tx: DataFrame, ident: DataFrame, key: str = "TransactionID",
    policy: SkewPolicy = DEFAULT_POLICY, check_unique: bool = True,
) -> DataFrame:
    """Every transaction with its identity row, if any, and no row twice.

    The check also counts the identity rows, which decide on a broadcast. Callers that know the keys to be unique leave it out with
    `check_unique=False`; the join is then planned by Spark from what it measures at run time.
    """
    if not check_unique:
        return tx.join(ident, key, "left")
    found = ident.groupBy(key).count().agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    if (found["most"] or 0) > 1:
        raise DuplicateKeyError(f"{key} repeats on the identity side")
    # the assumed bytes of a row are those of six columns
    rows = (found["rows"] or 0) * (1 + len(ident.columns) // 6)
    if rows * policy.row_bytes > policy.broadcast_bytes:  # keys are unique: hashed in each task, and the transactions need no sort
        ident = hashed(ident, policy, rows)
    return lookup(tx, ident, key, policy, rows)


def match_report(tx: DataFrame, ident: DataFrame, key: str = "TransactionID") -> DataFrame:
    """Rows, matched rows and match rate of the identity join."""
    marked = tx.select(key).join(ident.select(key).distinct().withColumn("__hit", F.lit(1)), key, "left")
    hit = F.coalesce("__hit", F.lit(0))
    return marked.agg(
        F.count(F.lit(1)).alias("rows_total"), F.sum(hit).alias("rows_matched"), F.avg(hit).alias("match_rate")
    )


def map_lookup(col: str, mapping: dict, default=None) -> str:
    """SQL text of a constant map lookup with a default for missing and unknown keys."""
    return f"coalesce(try_element_at({map_of(mapping)}, {col}), {lit(default)})"


def unique_ids(df: DataFrame, id_col: str, policy: SkewPolicy = DEFAULT_POLICY) -> bool:
    """Whether every row has an id of its own; counted on the id alone unless the policy knows."""
    if policy.unique_ids is not None:
        return policy.unique_ids
    if id_col not in df.schema.names:
        return False
    counted = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("__n"))
    return counted.where(F.col(id_col).isNull() | (F.col("__n") > 1)).limit(1).isEmpty()


def on_projection(df: DataFrame, needed: list[str], build, id_col: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Run `build` on the columns it needs and join its results back by id when the frame is
    wide, so that shuffles inside `build` move narrow rows. Only ids that are present and unique
    can be joined back; other frames are built whole, with the same rows."""
    if len(df.schema.names) <= policy.narrow_over or not unique_ids(df, id_col, policy):
        return build(df)
    here = set(df.schema.names)
    needed = [c for c in dict.fromkeys([id_col, *needed]) if c in here]
    built = build(df.select(*needed))
    fresh = [c for c in built.schema.names if c not in needed]
    return df.drop(*fresh).join(built.select(id_col, *fresh), id_col, "left")
