import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import metrics
from ledgerlens.session import scratch_path
from ledgerlens.streaming import alerts, counters, drift
from conftest import rows


def scores(spark, data):
    return spark.createDataFrame(data, "isFraud int, score double")


def test_tied_scores(spark):
    out = metrics.ranking_quality(scores(spark, [(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)]), "isFraud", "score").first()
    assert out["roc_auc"] == pytest.approx(0.875) and out["average_precision"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)


def test_auc_mirrors(txn):
    auc = metrics.ranking_quality(txn, "isFraud", "score").first()["roc_auc"]
    back = metrics.ranking_quality(txn.withColumn("score", 1 - F.col("score")), "isFraud", "score").first()["roc_auc"]
    assert auc == pytest.approx(1 - back)


def test_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "isFraud int, pred int")
    row = metrics.classification_rates(metrics.confusion_counts(df, "isFraud", "pred")).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_batch_summary(spark):
    df = spark.createDataFrame([(1001, 0, 0.1), (1002, 1, 0.9)], "TransactionID bigint, pred int, prob double")
    row = metrics.batch_summary(df, "pred").first()
    assert (row["total"], row["fraud_count"], row["fraud_rate"]) == (2, 1, 50.0)
    assert metrics.mean_confidence(df, "pred", "prob").first()[0] == pytest.approx(0.9)
    empty = metrics.batch_summary(df.where("false"), "pred").first()
    assert (empty["total"], empty["fraud_count"], empty["fraud_rate"]) == (0, 0, 0.0)


def test_ks_extremes(spark):
    a = spark.createDataFrame([(float(i),) for i in range(50)], "p double")
    assert metrics.ks_distance(a, a, "p").first()[0] == 0.0
    assert metrics.ks_distance(a, a.select((F.col("p") + 100).alias("p")), "p").first()[0] == 1.0


@pytest.mark.parametrize("n,drifted", [(99, 0), (100, 1)])
def test_minimum_window(spark, n, drifted):
    window = spark.createDataFrame([(0.99,)] * n, "prob double")
    row = drift.drift_report(window, drift.reference_sample(spark)).first()
    assert row["samples_in_window"] == n
    assert row["prediction_drift_alert"] == drifted and row["label_drift_alert"] == drifted


def test_reference_sample(spark):
    mean = drift.reference_sample(spark).agg(F.avg("prob")).first()[0]
    assert mean == pytest.approx(1 / 29, abs=1e-3)


def test_repeated_batch_changes_nothing(spark):
    root = scratch_path(spark, "state")
    batch = lambda lo, hi: spark.range(lo, hi).selectExpr("id AS sec", "id AS seq", "'v1' AS model_version", "0.1D AS prob")
    drift.window_batch(batch(0, 8), 0, root, n=5)
    for _ in range(2):
        window = drift.window_batch(batch(8, 10), 1, root, n=5)
        assert [r["seq"] for r in rows(window, "seq")] == [5, 6, 7, 8, 9]


def test_counter_reset(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("a", 3, 2)], "k string, sec int, value int")
    assert [r["increase"] for r in rows(alerts.counter_increase(df, "k"), "sec")] == [None, 4, 2]


def test_sustained(spark):
    data = [(0, 1), (60, 9), (120, 9), (180, 9), (240, 1), (300, 9)]
    df = spark.createDataFrame([("s", t, float(v)) for t, v in data], "series string, sec int, value double")
    out = rows(alerts.sustained(df, "series", "value > 5", 120), "sec")
    assert [r["firing"] for r in out] == [0, 0, 0, 1, 0, 0]
    assert [r["run_start"] for r in out] == [None, 60, 60, 60, None, 300]


def test_quantile_in_buckets(spark):
    log = spark.createDataFrame([(0.05,)] * 98 + [(1.5,), (30.0,)], "latency_s double").withColumn("ts", F.lit("2024-01-01 00:00:01").cast("timestamp"))
    assert alerts.latency_quantile(log).first()["quantile"] == pytest.approx(2.0)
    assert alerts.latency_quantile(log, q=0.999).first()["quantile"] == 10.0
    assert alerts.latency_quantile(log, q=0.49).first()["quantile"] == pytest.approx(0.05)


def test_rules():
    assert alerts.RULES_BY_NAME["AbnormalFraudRate"].hold_seconds == 600 and len(alerts.RULES) == 10


def test_unlabelled_rows_do_not_count(spark):
    df = spark.createDataFrame([("x",), (None,), ("x",)], "error_type string")
    assert [tuple(r) for r in counters.counter(df, ["error_type"]).collect()] == [("x", 2)]


def test_sliding_rate_on_a_stream(spark):
    inbox, ck = scratch_path(spark, "rate-in"), scratch_path(spark, "rate-ck")
    log = spark.range(600).selectExpr("timestamp_seconds(1704067200 + id) AS ts", "'/predict' AS endpoint")
    log.write.parquet(inbox)
    stream = spark.readStream.schema(log.schema).parquet(inbox)
    query = (
        alerts.sliding_rate(stream, ["endpoint"], watermark="1 hour").writeStream.outputMode("complete")
        .option("checkpointLocation", ck).format("memory").queryName("sliding").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.table("sliding")
    assert got.exceptAll(alerts.sliding_rate(log, ["endpoint"])).count() == 0 and got.count() == 14
