"""Stored layout for joins by id: tables bucketed alike join bucket by bucket, without an exchange."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import DEFAULT_POLICY, SkewPolicy, hot_keys, input_bytes, lookup
from ..session import scratch_path

BUCKET_BYTES = 256 << 20  # stored bytes that one task of a later join should read


@dataclass(frozen=True)
class BucketedTable:
    """A table in two parts: `name` holds the rows bucketed by `key`; `loose`, if any, the rows of keys that would overfill a bucket."""

    name: str
    key: str
    buckets: int
    loose: str | None = None


def bucket_count(*tables: DataFrame, bytes_per_bucket: int = BUCKET_BYTES) -> int:
    """Buckets that tables joined with each other should share: enough for the largest of them."""
    return max(1, *(-(-input_bytes(t) // bytes_per_bucket) for t in tables))


def store_bucketed(
    df: DataFrame, key: str, buckets: int, name: str | None = None, partition_by=(), path: str | None = None, policy: SkewPolicy = DEFAULT_POLICY,
) -> BucketedTable:
    """Write `df` as Parquet below the shared folder (or `path`), bucketed and sorted by `key`.

    Rows are exchanged by the same hash that buckets use, so a task writes one file for each partition value and bucket. Rows without
    key all have one hash, and a key with more than `policy.hot_rows` rows would fill one task: both kinds go to a plain table of
    their own, with their key as it is. An empty table gives empty buckets.
    """
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex[:12]}"
    path = path or scratch_path(spark, name)
    found = hot_keys(df, key, policy)
    dense, loose = df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
    if found:
        few = F.broadcast(found[0].where(F.col(key).isNotNull()).select(key))  # rows / hot_rows keys at most
        loose = loose.unionByName(dense.join(few, key, "left_semi").select(*df.columns))
        dense = dense.join(few, key, "left_anti").select(*df.columns)
    spare = f"{name}_loose"
    for table, rows in ((name, dense.repartition(buckets, key)), (spare, loose)):
        writer = rows.write.format("parquet").mode("overwrite").option("path", f"{path}/{table}")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if table == name:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(table)
    return BucketedTable(name, key, buckets, None if spark.table(spare).isEmpty() else spare)


def read_bucketed(spark: SparkSession, stored: BucketedTable) -> DataFrame:
    """All rows of a stored table."""
    dense = spark.table(stored.name)
    return dense if stored.loose is None else dense.unionByName(spark.table(stored.loose))


def join_bucketed(
    spark: SparkSession, left: BucketedTable, right: BucketedTable, where: str | None = None, policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Left join of two tables stored by the same key, every left row kept; `where` is applied to left rows at the scan.

    The right key must be unique (as for `merge_identity`), and then the right side has no loose rows but those without key, which match
    nothing. Bucketed rows are merged bucket by bucket. Loose left rows belong to few keys: the right rows of those are looked up in a
    table counted before it is broadcast, so a hot key is never shuffled; rows without key get nulls.
    """
    if left.key != right.key or left.buckets != right.buckets:
        raise ValueError("both tables must be bucketed by the same key into as many buckets")
    key = left.key
    only = (lambda df: df.where(where)) if where else (lambda df: df)
    lookup_rows = spark.table(right.name)
    # the hint keeps bucket order of work at every size; an automatic broadcast would exchange the right side
    joined = only(spark.table(left.name)).join(lookup_rows.hint("merge"), key, "left")
    if left.loose is None:
        return joined
    loose = only(spark.table(left.loose))
    keys = spark.table(left.loose).where(F.col(key).isNotNull()).select(key).distinct()
    few = lookup_rows.join(keys.hint("broadcast"), key, "left_semi")
    return joined.unionByName(lookup(loose, few, key, policy, few.count() * (1 + len(few.columns) // 6)).select(*joined.columns))
