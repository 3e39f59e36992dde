"""Bucketed tables join without an exchange and lose no row."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.joins import merge_identity
from ledgerlens.operators.skew import SkewPolicy
from ledgerlens.sources.layout import bucket_count, join_bucketed, read_bucketed, store_bucketed
from conftest import rows

KEY = "TransactionID"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sorted_rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_no_exchange_and_the_same_rows(spark, txn, ident):
    left, right = store_bucketed(txn, KEY, 8), store_bucketed(ident, KEY, 8)
    out = join_bucketed(spark, left, right)
    assert "Exchange" not in plan(out) and "SortMergeJoin" in plan(out)
    assert left.loose is None and sorted_rows(out) == sorted_rows(merge_identity(txn, ident))


def test_days_are_pruned_at_the_scan(spark, txn, ident):
    days = txn.withColumn("day", F.expr("CAST(TransactionDT DIV 86400 AS INT)"))
    left, right = store_bucketed(days, KEY, 8, partition_by=["day"]), store_bucketed(ident, KEY, 8)
    out = join_bucketed(spark, left, right, where="day = 3")
    text = plan(out)
    assert "Exchange" not in text and "day" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted_rows(out) == sorted_rows(merge_identity(days.where("day = 3"), ident))


def test_hot_and_missing_keys_stay_out_of_the_buckets(spark):
    left = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS k", "id AS row")
    right = spark.range(0, 900, 7).selectExpr("id AS k", "id * 2 AS v").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, -1L AS v"))
    forced = SkewPolicy(hot_rows=50)
    a, b = store_bucketed(left, "k", 4, policy=forced), store_bucketed(right, "k", 4, policy=forced)
    assert a.loose and spark.table(a.name).where("k IS NULL OR k = 7").isEmpty() and spark.table(a.loose).count() == 600
    assert sorted_rows(read_bucketed(spark, a)) == sorted_rows(left) and sorted_rows(read_bucketed(spark, b)) == sorted_rows(right)
    assert sorted_rows(join_bucketed(spark, a, b)) == sorted_rows(left.join(right, "k", "left"))
    assert sorted_rows(join_bucketed(spark, a, b, where="row < 100")) == sorted_rows(left.where("row < 100").join(right, "k", "left"))


def test_one_file_a_bucket(spark, txn):
    stored = store_bucketed(txn, KEY, 6)
    assert len(spark.table(stored.name).inputFiles()) == 6 and bucket_count(txn, bytes_per_bucket=1 << 30) == 1


def test_empty_tables_and_unlike_layouts(spark, txn, ident):
    none, right = store_bucketed(txn.limit(0), KEY, 8), store_bucketed(ident.limit(0), KEY, 8)
    assert join_bucketed(spark, none, right).count() == 0
    assert rows(join_bucketed(spark, store_bucketed(txn, KEY, 8), right), KEY)[0]["id_01"] is None
    with pytest.raises(ValueError):
        join_bucketed(spark, none, store_bucketed(ident, KEY, 4))
