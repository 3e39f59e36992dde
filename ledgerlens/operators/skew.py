"""Size checks that decide between a simple plan and one that survives hot keys.

The bytes of the scanned inputs are known without a job. Below `small_bytes` every group fits
one task whatever its share, so the plain window or a broadcast is safe. Above it, hot keys are
measured with one map-side-combined count and treated apart.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


@dataclass(frozen=True)
class SkewPolicy:
    small_bytes: int = 256 << 20       # inputs below this need no skew handling
    broadcast_bytes: int = 64 << 20    # largest table ever hinted for broadcast
    row_bytes: int = 96                # assumed width of a statistics row when counted
    hash_bytes: int = 128 << 20        # share of a table that one task may hash; beyond, Spark sorts and can spill
    hot_rows: int = 5_000_000          # a key with more rows is split over tasks
    block_rows: int = 1_000_000        # rows of a hot key handled by one task
    slice_rows: int = 2_000_000        # rows per range slice
    narrow_over: int = 40              # wider frames compute features on a projection
    small: bool | None = None          # size decision already taken for the input
    unique_ids: bool | None = None     # whether the ids are known to be present and unique

    def settled(self, df: DataFrame) -> "SkewPolicy":
        """Decide once from the input; frames derived row by row keep the decision."""
        return self if self.small is not None else replace(self, small=is_small(df, self))


DEFAULT_POLICY = SkewPolicy()


def input_bytes(df: DataFrame) -> int:
    """Bytes of all relations the plan reads, before pruning. Operators here join on unique
    keys only, so results never hold more rows than their inputs."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    try:
        return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    except ValueError:  # an estimate with thousands of digits: nothing is known
        return 1 << 63


def is_small(df: DataFrame, policy: SkewPolicy) -> bool:
    return policy.small if policy.small is not None else input_bytes(df) <= policy.small_bytes


def broadcast_if_small(table: DataFrame, policy: SkewPolicy, rows: int | None = None) -> DataFrame:
    """Hint a broadcast only for a table whose size is known: counted rows, or the bytes it is
    read from. Otherwise AQE chooses, and splits skewed join partitions."""
    size = input_bytes(table) if rows is None else rows * policy.row_bytes
    return F.broadcast(table) if size <= policy.broadcast_bytes else table


def hashed(table: DataFrame, policy: SkewPolicy, rows: int) -> DataFrame:
    """Hint that tasks hash their share of a table with one row per key, so that the rows looked up need no sort. A hash
    table cannot spill: shares beyond `hash_bytes` are left to Spark's sort."""
    tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.hint("shuffle_hash") if rows * policy.row_bytes <= tasks * policy.hash_bytes else table


def spread_small(df: DataFrame, key: str, policy: SkewPolicy) -> DataFrame:
    """A small input often sits in one file and would be worked on by one core; share it out.
    Large inputs have more splits than cores and are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not is_small(df, policy) or key not in df.schema.names or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores, key)


def lookup(df: DataFrame, table: DataFrame, on, policy: SkewPolicy, rows: int | None = None) -> DataFrame:
    """Left join that keeps every row of `df`; null and unseen keys get nulls."""
    return df.join(broadcast_if_small(table, policy, rows), on, "left")


def skewed_lookup(
    df: DataFrame, table: DataFrame, on: list[str], weight: str, total: int, spread: str, policy: SkewPolicy
) -> DataFrame:
    """Left join with a large statistics table whose `weight` column counts the rows per key.

    Keys with more than `hot_rows` rows are few, `total / hot_rows` at most: they are looked up
    by broadcast. Their rows, and rows with a missing key, then join the remaining keys under a
    salt that matches nothing, so no task of the shuffle receives a hot key. Rows come out sorted
    by key, so a later exchange or file of them packs well; a hash join was measured to move more bytes in all.
    """
    if total <= policy.hot_rows:  # no key can be hot
        return df.join(table, on, "left")
    values = [c for c in table.schema.names if c not in on]
    hot = table.where(F.col(weight) > policy.hot_rows).withColumnsRenamed({c: f"__hot_{c}" for c in values})
    cold = table.where(F.col(weight) <= policy.hot_rows).withColumn("__salt", F.lit(0))
    known = " AND ".join(f"`{c}` IS NOT NULL" for c in on)
    salt = f"CASE WHEN __hot_{weight} IS NULL AND {known} THEN 0 ELSE 1 + CAST(pmod(xxhash64(`{spread}`), 100000) AS INT) END"
    marked = lookup(df, hot, on, policy, total // max(policy.hot_rows, 1)).selectExpr("*", f"{salt} AS __salt")
    joined = marked.join(cold, [*on, "__salt"], "left")
    kept = [f"`{c}`" for c in df.schema.names]
    return joined.selectExpr(*kept, *[f"coalesce(`__hot_{c}`, `{c}`) AS `{c}`" for c in values])


def hot_keys(df: DataFrame, key: str, policy: SkewPolicy) -> tuple[DataFrame, int, int] | None:
    """Keys holding more than `hot_rows` rows: `(table(key, rows), how many, rows in all)`.

    The table has at most `total rows / hot_rows` entries; it is written out once so both
    sides of the split see the same keys. None when no key is hot.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    hot = materialise(counted.where(F.col("__rows") > policy.hot_rows))
    size = hot.agg(F.count(F.lit(1)).alias("n"), F.sum("__rows").alias("rows")).first()
    return (hot, size["n"], size["rows"]) if size["n"] else None
