import re
from dataclasses import replace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens.operators import split
from ledgerlens.operators.skew import SkewPolicy
from ledgerlens.plans import model as M
from ledgerlens.plans import prepare as P
from ledgerlens.plans.features import with_card_id
from ledgerlens.session import scratch_path
from conftest import rows


def test_stratified_split_keeps_the_classes(txn):
    train, test = split.stratified_split(txn, "TransactionID", "isFraud")
    assert train.count() + test.count() == txn.count()
    for c in (0, 1):
        n, k = (d.where(F.col("isFraud") == c).count() for d in (txn, test))
        assert abs(k - 0.2 * n) <= 1
    again = split.stratified_split(txn.repartition(5), "TransactionID", "isFraud")[1]
    assert again.select("TransactionID").exceptAll(test.select("TransactionID")).count() == 0


def test_three_way_split(txn):
    parts = split.shares_split(txn.select("TransactionID"), "TransactionID", (0.82, 0.09, 0.09))
    counts = [p.count() for p in parts]
    assert sum(counts) == txn.count() and counts[0] > 0.7 * txn.count()


def test_codes(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "k string")
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "k string")
    fitted = P.fit_dictionaries(train, ["k"])
    assert sorted(r[0] for r in P.encode(new, fitted, ["k"], -999.0, -1.0).collect()) == [-999.0, -1.0, 0.0, 1.0, 2.0]
    joined = P.Dictionaries(fitted.table, fitted.sizes, {}, fitted.totals)
    assert sorted(r[0] for r in P.encode(new, joined, ["k"], -999.0, -1.0).collect()) == [-999.0, -1.0, 0.0, 1.0, 2.0]


def test_codes_beyond_the_broadcast_limit(txn):
    cols = ["card_id", "P_emaildomain"]
    df = with_card_id(txn).select("TransactionID", *cols)
    fitted = replace(P.fit_dictionaries(df, cols), inline={})
    small = P.encode(df, fitted, cols, -999.0, -1.0)
    large = P.encode(df, fitted, cols, -999.0, -1.0, SkewPolicy(small_bytes=0, broadcast_bytes=0, hot_rows=50))
    assert small.exceptAll(large).count() == 0 and small.count() == large.count() == txn.count()


WIDE = SkewPolicy(small_bytes=0, broadcast_bytes=0, hot_rows=50)


def wide_exchanges(df, column):
    """Exchanges of the plan that carry the column."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return len(re.findall(rf"\(\d+\) Exchange\nInput \[\d+\]: \[[^\]]*\b{column}#", plan))


def test_many_dictionaries_exchange_the_wide_rows_once(txn):
    cols = ["card_id", "P_emaildomain", "DeviceInfo", "payload_key"]
    df = with_card_id(txn).selectExpr("TransactionID", "card_id", "P_emaildomain", "concat('d', card1) AS DeviceInfo", "IF(TransactionID % 5 = 0, NULL, concat('k', TransactionID)) AS payload_key", "TransactionAmt AS payload")
    fitted = replace(P.fit_dictionaries(df.where("TransactionID % 3 > 0"), cols), inline={})
    small = P.encode(df, fitted, cols, -999.0, -1.0)
    large = P.encode(df, fitted, cols, -999.0, -1.0, replace(WIDE, unique_ids=True))
    assert small.exceptAll(large).count() == 0 and small.count() == large.count() == txn.count()
    spark = txn.sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no table could be broadcast
    try:
        plans = {unique: P.encode(df, fitted, cols, -999.0, -1.0, replace(WIDE, hot_rows=10**9, unique_ids=unique)) for unique in (True, False)}
        assert wide_exchanges(plans[True], "payload") == 1 and wide_exchanges(plans[False], "payload") >= len(cols)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_repeated_ids_are_encoded_too(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (None, "c", "y"), (None, "a", "z")], "TransactionID long, j string, k string")
    fitted = replace(P.fit_dictionaries(df, ["j", "k"]), inline={})
    got = P.encode(df, fitted, ["j", "k"], -999.0, -1.0, WIDE).collect()
    assert sorted((r["j"], r["k"]) for r in got) == [(0.0, 0.0), (0.0, 2.0), (1.0, -999.0), (2.0, 1.0)]


def test_components_are_eigenvectors(txn):
    cols = ["V1", "V2", "V3", "V12", "V13", "V138"]
    fitted, _ = P.fit_components(txn, cols, 0.96)
    assert P.components_residual(txn, fitted, cols) < 1e-6
    shifted = txn.withColumn("V1", F.col("V1") + F.col("V2"))
    assert P.components_residual(shifted, fitted, cols) > 1e-3


def test_columns_without_values_are_left_out(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert P.known_columns(df, ["a", "b"]) == ["a"]
    assert [r[0] for r in P.fill_constant(df, ["a"], -999).select("a").collect()] == [1.0, -999.0]


def test_components_explain_the_variance(txn):
    cols = ["V1", "V2", "V3", "V12", "V13", "V138"]
    fitted, kept = P.fit_components(txn, cols, 0.96)
    shares = fitted.stages[-2].explainedVariance.toArray()
    assert sum(shares[:kept]) >= 0.96 > sum(shares[: kept - 1])
    assert fitted.transform(txn).select(F.size(vector_to_array("pca"))).first()[0] == kept


def test_class_weights(txn):
    balanced = M.balanced_weight(txn, "isFraud")
    sums = M.with_weights(txn, "isFraud", balanced).groupBy("isFraud").agg(F.sum("weight").alias("w"))
    a, b = (r["w"] for r in rows(sums, "isFraud"))
    assert a == pytest.approx(b)


@pytest.fixture(scope="module")
def trained(txn, ident):
    df = txn.join(ident, "TransactionID", "left").drop("score", "V12", "dist2")
    train, test = split.stratified_split(df, "TransactionID", "isFraud")
    model, metrics, seconds = M.train_fraud_model(train, test, M.boosted_trees(rounds=2, depth=3))
    return train, test, model, metrics, seconds


def test_metrics_for_both_sets(trained):
    *_, model, metrics, seconds = trained
    got = {r["split"]: r for r in metrics.collect()}
    assert set(got) == {"train", "test"} and 0.5 < got["train"]["roc_auc"] <= 1.0 and seconds > 0
    assert model.metrics["test"]["accuracy"] == got["test"]["accuracy"]


def test_every_key_gets_its_own_score(spark, trained):
    _, test, model, *_ = trained
    a = model.predict_proba(test)
    assert a.count() == test.count() == a.select("TransactionID").distinct().count()
    b = model.predict_proba(test.orderBy(F.rand(3)).repartition(3))
    diff = a.join(b.withColumnRenamed("fraud_probability", "q"), "TransactionID").where("abs(fraud_probability - q) > 1e-9")
    assert diff.count() == 0


def test_stored_model_scores_the_same(spark, trained):
    _, test, model, *_ = trained
    root = scratch_path(spark, "models")
    assert model.save(root) == 1
    stored = M.predict_fraud(test.drop("isFraud"), root)
    assert stored.exceptAll(model.predict(test)).count() == 0 and stored.count() == test.count()
