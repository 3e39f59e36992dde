"""Penalised trees against a plain numpy booster, patience against measures taken again, saving."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ledgerlens.plans import boosting as B
from ledgerlens.plans import model as M
from ledgerlens.session import scratch_path

COLUMNS = ["TransactionAmt", "card2", "addr1", "D1", "V1", "V13"]


@pytest.fixture(scope="module")
def vectors(txn):
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(-999.0)) for c in COLUMNS]
    return txn.select("TransactionID", "isFraud", array_to_vector(F.array(*cols)).alias("features"))


def plain_booster(x, y, w, s):
    """The same trees by recursion over all distinct values."""
    margin, out = np.zeros(len(x)), []
    half = lambda g: np.sign(g) * max(abs(g) - s.l1, 0.0)

    def build(rows, depth):
        g, h = G[rows].sum(), H[rows].sum()
        best = (1e-9, None)
        if depth:
            for f in range(x.shape[1]):
                for v in np.unique(x[:, f])[:-1]:
                    left = x[rows, f] <= v
                    gl, hl = G[rows][left].sum(), H[rows][left].sum()
                    if hl < s.child_weight or h - hl < s.child_weight:
                        continue
                    gain = half(gl) ** 2 / (hl + s.l2) + half(g - gl) ** 2 / (h - hl + s.l2) - half(g) ** 2 / (h + s.l2)
                    if gain > best[0] + 1e-9:
                        best = (gain, f, v)
        if best[1] is None:
            margin[rows] += -s.learning_rate * half(g) / (h + s.l2)
            return
        side = x[rows, best[1]] <= best[2]
        build(rows[side], depth - 1)
        build(rows[~side], depth - 1)

    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-margin))
        G, H = w * (p - y), w * p * (1 - p)
        build(np.arange(len(x)), s.depth)
        out.append(margin.copy())
    return out


def test_equals_a_plain_booster(vectors):
    small = vectors.where("TransactionID % 3 = 0").select("TransactionID", "isFraud", array_to_vector(F.slice(vector_to_array("features"), 2, 5)).alias("features"))
    local = small.orderBy("TransactionID").collect()
    x, y = np.array([r["features"].toArray() for r in local]), np.array([r["isFraud"] for r in local], float)
    s = B.TreeSettings(rounds=3, depth=3, learning_rate=0.3, row_share=1.0, column_share=1.0, store_every=2)
    model = B.PenalisedTrees(s).fit(M.with_weights(small.repartition(5), "isFraud", 27.0))
    got = small.select("TransactionID", model.margin(F.col("features")).alias("m")).orderBy("TransactionID").toPandas()["m"].to_numpy()
    want = plain_booster(x, y, np.where(y == 1, 27.0, 1.0), s)[-1]
    assert len(model.trees) == 3 and np.allclose(got, want, atol=1e-9) and got.std() > 0.01


def test_patience_and_measures(spark, vectors):
    est = M.penalised_trees(rounds=12, depth=2, learning_rate=0.5, column_share=0.7, store_every=3, watch="loss")
    model = M.fit_with_patience(vectors, est, patience=2, validation_share=0.3)
    best, _ = M.best_round(model.measures, 2)
    assert len(model.trees) == best and (len(model.measures) == 12 or len(model.measures) - best >= 2)
    held = vectors.where(M.hash_bucket("TransactionID", M.DEFAULT.seed + 1) < 30_000)
    for k in range(1, best + 1):
        some = B.PenalisedTreesModel(model.trees[:k])
        scored = held.select("isFraud", some.margin(F.col("features")).alias("m"))
        loss = scored.select(F.avg(F.log1p(F.exp(F.when(F.col("isFraud") == 1, -F.col("m")).otherwise(F.col("m")))))).first()[0]
        assert loss == pytest.approx(model.measures[k - 1], abs=1e-9)


def test_area_is_ranked_by_steps(vectors):
    model = M.fit_with_patience(vectors, M.penalised_trees(rounds=3, depth=3, learning_rate=0.5), patience=5, validation_share=0.4)
    held = M.scored_rows(model, vectors.where(M.hash_bucket("TransactionID", M.DEFAULT.seed + 1) < 40_000))
    area = M.evaluate(held, "isFraud", "prediction_isFraud", "fraud_probability").first()["roc_auc"]
    assert area == pytest.approx(-model.measures[len(model.trees) - 1], abs=2e-3) and area > 0.8


def test_patience_with_spark_trees(vectors):
    est = M.boosted_trees(rounds=4, depth=2, learning_rate=0.5, column_share=1.0)
    model = M.fit_with_patience(vectors, est, patience=1, first=2)
    assert 1 <= model.getNumTrees <= 4


def test_saved_trees(spark, vectors):
    model = B.PenalisedTrees(B.TreeSettings(rounds=2, depth=4)).fit(M.with_weights(vectors, "isFraud", 27.0))
    path = scratch_path(spark, "trees")
    model.save(spark, path)
    again = B.PenalisedTreesModel.load(path)
    both = vectors.select(model.margin(F.col("features")).alias("a"), again.margin(F.col("features")).alias("b"))
    assert both.where("a <> b").isEmpty() and again.settings == model.settings and again.importances() == model.importances()


def test_summaries_keep_ranks():
    r = np.random.default_rng(1)
    data = r.normal(size=50_000)
    parts = [B.merged_summary(p, np.ones(len(p)), 512) for p in np.split(data, 10)]
    values, counts = B.merged_summary(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), 512)
    ranks = np.searchsorted(np.sort(data), values, side="right") / len(data)
    assert np.abs(ranks - np.cumsum(counts) / len(data)).max() < 2.5 / 512 and counts.sum() == len(data)


def test_missing_and_constant_features(spark):
    rows = [(k, float(k % 4 == 0), [float("nan") if k % 4 == 0 else float(k % 3), 1.0]) for k in range(400)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud double, x array<double>").select("TransactionID", "isFraud", array_to_vector("x").alias("features"))
    model = B.PenalisedTrees(B.TreeSettings(rounds=1, depth=2, row_share=1.0, column_share=1.0), weight=None).fit(df)
    assert model.trees[0].feature[0] == 0 and set(model.importances()) == {0}
    out = M.scored_rows(model, df.select("TransactionID", "isFraud", "features"))
    assert out.where("fraud_probability > 0.5").count() == 100 == out.where("isFraud = 1 AND fraud_probability > 0.5").count()
    assert B.PenalisedTrees(B.TreeSettings(rounds=1, depth=2), weight=None).fit(df.limit(0)).trees[0].value.sum() == 0
