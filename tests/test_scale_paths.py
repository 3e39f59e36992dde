"""The paths for large inputs give the same rows as the simple ones."""

from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import eda, joins, metrics
from ledgerlens.operators.ordered import dense_position, running_totals
from ledgerlens.operators.skew import SkewPolicy, hot_keys, input_bytes
from ledgerlens.plans import features as G
from ledgerlens.streaming import alerts, drift
from conftest import frame

# Everything counts as large: keys above 40 rows are split into blocks of 15.
FORCED = SkewPolicy(small_bytes=0, hot_rows=40, block_rows=15, slice_rows=100)


@pytest.fixture(scope="module")
def skewed(txn):
    """A third of all rows belong to one card."""
    third = F.col("TransactionID") % 3 == 0
    hot = lambda c, v: F.when(third, F.lit(v).cast(txn.schema[c].dataType)).otherwise(F.col(c)).alias(c)
    keys = {"card1": 1, "card2": 2, "card3": 3, "card4": "visa", "card5": 5, "card6": "debit", "addr1": 300, "D1": 1}
    return txn.select(*[c for c in txn.schema.names if c not in keys], *[hot(c, v) for c, v in keys.items()])


def same(a, b, key="TransactionID"):
    a, b = frame(a, key), frame(b, key)
    pd.testing.assert_frame_equal(a, b[a.columns], check_dtype=False)


def test_card_sequence_with_a_hot_card(skewed):
    df = G.with_card_id(skewed)
    assert hot_keys(df, "card_id", FORCED) is not None
    same(G.card_sequence(df), G.card_sequence(df, policy=FORCED))


def test_uid_velocity_with_a_hot_user(skewed):
    df = G.uid_features(G.email_scalars(G.card_texts(G.with_card_id(skewed)))).select(
        "TransactionID", "TransactionDT", "uid1", "uid2"
    )
    same(G.uid_velocity(df), G.uid_velocity(df, policy=FORCED))


def test_rolling_rates_with_a_hot_model(spark, skewed):
    log = skewed.selectExpr("TransactionID AS seq", "TransactionDT AS sec", "'v1' AS model_version", "score AS prob")
    same(drift.rolling_rates(log, n=20), drift.rolling_rates(log, n=20, policy=replace(FORCED, block_rows=30)), "seq")


def test_sustained_with_a_hot_series(skewed):
    series = skewed.selectExpr("'s' AS series", "TransactionDT AS sec", "TransactionID", "score AS value")
    args = ("series", "value > 0.2", 600, ("sec", "TransactionID"))
    same(alerts.sustained(series, *args), alerts.sustained(series, *args, policy=FORCED))


def test_numbering_and_running_totals(skewed):
    df = skewed.select("TransactionID", "card6", "TransactionAmt")
    for key in (None, ["card6"]):
        same(dense_position(df, ["TransactionID"], key), dense_position(df, ["TransactionID"], key, policy=FORCED))
    values = df.groupBy("card6", "TransactionAmt").agg(F.count(F.lit(1)).alias("n"))
    for group in ([], ["card6"]):
        order = ["TransactionAmt"] if group else ["TransactionAmt", "card6"]
        a = running_totals(values, order, {"upto": "n"}, group)
        b = running_totals(values, order, {"upto": "n"}, group, FORCED)
        same(a, b, ["card6", "TransactionAmt"])


def test_quality_and_quartiles(skewed):
    a = metrics.ranking_quality(skewed, "isFraud", "score", ["card6"])
    same(a, metrics.ranking_quality(skewed, "isFraud", "score", ["card6"], FORCED), "card6")
    same(eda.describe_by(skewed, "isFraud", "TransactionAmt"), eda.describe_by(skewed, "isFraud", "TransactionAmt", FORCED), "isFraud")
    half = skewed.where("card6 = 'debit'")
    one, two = (metrics.ks_distance(skewed, half, "score", p).first()[0] for p in (SkewPolicy(), FORCED))
    assert one == pytest.approx(two)


def test_chain_narrow_wide_and_large(skewed, ident):
    df = skewed.join(ident, "TransactionID", "left")
    fitted = G.fit_features(df)
    plain = G.feature_chain(df, fitted=fitted)
    same(plain, G.feature_chain(df, policy=SkewPolicy(narrow_over=5), fitted=fitted))
    same(plain, G.feature_chain(df, policy=FORCED, fitted=fitted))


def test_lookups_beyond_the_broadcast_limit(skewed):
    """Hot keys by broadcast, the others by shuffle, missing keys kept."""
    df = G.with_card_id(skewed).select("TransactionID", "card_id", "addr1", "TransactionAmt")
    large = SkewPolicy(small_bytes=0, hot_rows=60, broadcast_bytes=1500)
    for keys in (["card_id"], ["addr1"], ["card_id", "TransactionAmt"]):
        aggs = {"n": F.count(F.lit(1)), "top": F.max("TransactionAmt")}
        same(G.A.group_lookup(df, keys, aggs), G.A.group_lookup(df, keys, aggs, large))
    fitted = replace(G.A.fit_profiles(df, ["card_id", "addr1"], "TransactionAmt"), inline={})
    wanted = {"card_id": {"a": "n", "b": "amt_std"}, "addr1": {"c": "n"}}
    same(G.A.attach_profiles(df, fitted, wanted), G.A.attach_profiles(df, fitted, wanted, large))
    plan = G.A.attach_profiles(df, fitted, wanted, large)._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan


def test_order_and_partitioning_do_not_matter(skewed):
    df = G.with_card_id(skewed)
    one = G.card_sequence(df.orderBy(F.desc("TransactionAmt")).repartition(1))
    same(one, G.card_sequence(df.repartition(7)))


def test_nothing_is_broadcast_beyond_the_limit(skewed):
    tiny = SkewPolicy(small_bytes=0, broadcast_bytes=0, hot_rows=10**9)
    df = G.with_card_id(skewed)
    plan = G.A.group_lookup(df, ["card_id"], {"n": F.count(F.lit(1))}, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert input_bytes(skewed) > 0


def test_fitted_repeats_and_scores_beyond_the_broadcast_limit(txn):
    df = txn.selectExpr("*", "card1 % 7 AS user_id")
    fitted = G.fit_features(df)
    columns = ["TransactionID", "amt_repeat_count", "amount_zscore"]
    plain = G.feature_chain(df, fitted=fitted).select(*columns)
    spread = G.feature_chain(df, fitted=fitted, policy=SkewPolicy(broadcast_bytes=0, hot_rows=20)).select(*columns)
    assert plain.exceptAll(spread).count() == 0 and plain.count() == spread.count() == txn.count()
    assert "__salt" in spread._jdf.queryExecution().optimizedPlan().toString()
    assert plain.where("amt_repeat_count IS NULL OR amount_zscore IS NULL").count() == 0


def test_identity_join_counts_and_refuses_repeats(txn):
    ident = txn.where("TransactionID % 4 = 0").selectExpr("TransactionID", "concat('d', card1) AS DeviceInfo")
    known, counted = (joins.merge_identity(txn, ident, check_unique=c) for c in (False, True))
    assert known.exceptAll(counted).count() == 0 and counted.count() == txn.count()
    assert joins.merge_identity(txn, ident.limit(0)).where("DeviceInfo IS NOT NULL").count() == 0
    with pytest.raises(joins.DuplicateKeyError):
        joins.merge_identity(txn, ident.union(ident))
