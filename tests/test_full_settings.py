"""The model queries train with the full settings, and trees grown by one task equal those grown level by level over all tasks."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from checks import learning as L
from ledgerlens.plans import boosting as B
from ledgerlens.plans import first_order as O
from ledgerlens.plans import model as M
from ledgerlens.session import scratch_path


@pytest.fixture
def asked(monkeypatch):
    """Estimators that a query asks to be fitted; nothing is trained."""
    seen = []
    monkeypatch.setattr(L, "_CACHE", {})
    monkeypatch.setattr(L, "prepared_sets", lambda s, d: (None, None, "train", "test"))
    monkeypatch.setattr(M, "fit_classifier", lambda train, estimator, *a, **k: seen.append(estimator) or "model")
    monkeypatch.setattr(M, "scored_rows", lambda model, rows, *a: (model, rows))
    monkeypatch.setattr(M, "evaluate_sets", lambda model, sets, *a: (model, sets))
    return seen


def full_boosted(estimator):
    return (estimator.getMaxIter(), estimator.getMaxDepth(), estimator.getStepSize(), estimator.getSubsamplingRate(), estimator.getFeatureSubsetStrategy()) == (3000, 8, 0.02, 0.8, "0.7")


@pytest.mark.parametrize("query", ["boosted", "metrics_by_split", "fraud_model"])  # predictions and probabilities come from `fraud_model`
def test_boosted_trees_have_all_rounds(spark, asked, query):
    getattr(L, query)(spark, "nowhere")
    assert len(asked) == 1 and full_boosted(asked[0])


def test_penalised_trees_have_all_rounds(spark, asked):
    L.penalised(spark, "nowhere")
    assert [e.settings for e in asked] == [B.TreeSettings()] and (B.TreeSettings().rounds, B.TreeSettings().depth) == (3000, 8)


@pytest.fixture(scope="module")
def vectors(spark):
    """Rows with missing, constant and many-valued features, in several partitions; ids come twice."""
    r = np.random.default_rng(4)
    x = np.column_stack([r.normal(size=900), r.integers(0, 5, 900), np.ones(900), r.normal(size=900).round(2), np.where(r.random(900) < 0.2, np.nan, r.random(900))])
    y = (x[:, 0] + 0.7 * (x[:, 1] > 2) + r.normal(size=900) > 1.2).astype(int)
    rows = [(int(k // 2), int(y[k]), [float(v) for v in x[k]]) for k in range(900)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud int, x array<double>").repartition(5)
    return M.with_weights(df.select("TransactionID", "isFraud", array_to_vector("x").alias("features")), "isFraud", 27.0)


@pytest.mark.parametrize("watch", ["loss", "auc", None])
def test_one_task_grows_the_same_trees(vectors, watch):
    settings = B.TreeSettings(rounds=6, depth=4, learning_rate=0.4, store_every=2, patience=2, watch=watch or "auc")
    rows = vectors.withColumn("held", F.col("TransactionID") % 4 == 0)
    alone = B.PenalisedTrees(settings, validation="held" if watch else None)
    a, b = alone.fit(rows), replace(alone, task_bytes=0).fit(rows)
    assert a.getNumTrees == b.getNumTrees > 0 and np.allclose(a.measures, b.measures, atol=1e-9) and bool(a.measures) == bool(watch)
    for s, t in zip(a.trees, b.trees):
        assert (s.feature == t.feature).all() and (s.bin == t.bin).all() and (s.threshold == t.threshold).all()
        assert np.allclose(s.value, t.value, atol=1e-9) and np.allclose(s.gain, t.gain, atol=1e-9)


def test_compared_models_have_all_rounds_and_trees(spark, asked, monkeypatch):
    monkeypatch.setattr(M, "compare_models", lambda train, test, estimators: estimators)
    found = L.comparison(spark, "nowhere")
    assert list(found) == ["boosted", "forest"] and full_boosted(found["boosted"])
    assert (found["forest"].getNumTrees(), found["forest"].getMaxDepth()) == (200, 20)


def both_ways(rows, **settings):
    """A model grown in one task, and Spark's own of the same estimator."""
    estimator = M.boosted_trees(**settings)
    spark_own = estimator.copy()
    spark_own.task_bytes = 0
    return estimator.fit(rows), spark_own.fit(rows)


def full_rows(vectors):
    """Without missing values, which Spark's trees do not take apart."""
    return vectors.select("TransactionID", "isFraud", "weight", array_to_vector(F.transform(vector_to_array("features"), lambda x: F.nanvl(x, F.lit(-1.0)))).alias("features"))


def splits(tree):
    return [line.strip() for line in tree.toDebugString.split("\n") if "feature " in line]


def test_one_task_grows_the_trees_of_spark(spark, vectors, monkeypatch):
    rows, grown, own = full_rows(vectors), [], O.BoostedTrees._grown
    monkeypatch.setattr(O.BoostedTrees, "_grown", lambda self, *a: grown.append(1) or own(self, *a))
    # rounding decides between splits of the same gain, of which the seventh tree here has the first
    a, b = both_ways(rows, rounds=6, depth=4, learning_rate=0.3, row_share=1.0, column_share=1.0)
    assert grown == [1] and type(a) is type(b) and a.getNumTrees == b.getNumTrees == 6 and a.treeWeights == b.treeWeights and a.numFeatures == b.numFeatures == 5
    assert [splits(t) for t in a.trees] == [splits(t) for t in b.trees] and all(len(splits(t)) > 4 for t in a.trees)
    p, q = (sorted((r["TransactionID"], r["fraud_probability"]) for r in M.scored_rows(m, rows).collect()) for m in (a, b))
    assert np.allclose(p, q, atol=1e-9) and len(p) == 900
    assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray(), atol=1e-9)
    assert np.allclose(a.evaluateEachIteration(rows), b.evaluateEachIteration(rows), atol=1e-9)


def test_a_repeated_fit_draws_the_same(spark, vectors):
    rows = full_rows(vectors)
    estimator = M.boosted_trees(rounds=5, depth=3, learning_rate=0.3)
    a, b = estimator.fit(rows), estimator.fit(rows.repartition(3).sortWithinPartitions(F.rand(1)))
    assert [t.toDebugString.split("\n")[1:] for t in a.trees] == [t.toDebugString.split("\n")[1:] for t in b.trees]
    assert (a.getMaxIter(), a.getMaxDepth(), a.getSubsamplingRate(), a.getWeightCol()) == (5, 3, 0.8, "weight")
    first = estimator.copy({estimator.maxIter: 3}).fit(rows)
    assert [t.toDebugString.split("\n")[1:] for t in first.trees] == [t.toDebugString.split("\n")[1:] for t in a.trees[:3]]
    path = scratch_path(spark, "boosted")
    a.write().save(path)
    again = type(a).load(path)
    assert M.scored_rows(again, rows).exceptAll(M.scored_rows(a, rows)).isEmpty()


def test_thresholds_lie_between_values():
    few = O._midpoints(np.array([0.0, 1.0, 4.0]), np.array([1.0, 1.0, 1.0]), 31)
    many = O._midpoints(np.arange(1000.0), np.ones(1000), 31)
    assert few.tolist() == [0.5, 2.5] and len(many) == 31 and np.allclose(np.diff(many), 1000 / 32, atol=1)
