"""Training, evaluation and scoring with Spark ML classifiers."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field, replace

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, FeatureConfig
from ..operators import stats as A
from ..operators.joins import unique_ids
from ..operators.metrics import evaluate
from ..operators.skew import DEFAULT_POLICY, SkewPolicy
from ..operators.split import hash_bucket
from ..operators.validate import require_model, require_rows
from ..session import materialise, read_once, shared_folder
from ..sources.files import read_text, write_text
from ..sources.registry import ModelNotFoundError, next_version, resolve, version_path
from . import features as G
from .boosting import PenalisedTrees, PenalisedTreesModel, TreeSettings
from .first_order import BoostedTrees
from .prepare import Preparation, fit_preparation

# The boosted-tree and forest settings.
BOOSTED = {"rounds": 3000, "depth": 8, "learning_rate": 0.02, "row_share": 0.8, "column_share": 0.7, "patience": 80}
FOREST = {"trees": 200, "depth": 20}


def with_weights(df: DataFrame, label: str, positive_weight: float, name: str = "weight") -> DataFrame:
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0)))


def balanced_weight(df: DataFrame, label: str) -> float:
    """Weight of a positive row that makes both classes count the same."""
    one = df.agg(F.sum(label).alias("p"), F.count(label).alias("n")).first()
    return (one["n"] - one["p"]) / one["p"] if one["p"] else 1.0


def boosted_trees(
    label: str = "isFraud", rounds: int = BOOSTED["rounds"], depth: int = BOOSTED["depth"],
    learning_rate: float = BOOSTED["learning_rate"], row_share: float = BOOSTED["row_share"],
    column_share: float = BOOSTED["column_share"], seed: int = 6, validation: str | None = None,
    tolerance: float = 1e-4, min_weight_share: float = 0.0, checkpoint_every: int = 10,
) -> GBTClassifier:
    """Spark's boosted trees: first-order, without penalties; early stopping by a validation column and a tolerance. Small tables are grown in one task."""
    gbt = BoostedTrees(
        labelCol=label, featuresCol="features", weightCol="weight", maxIter=rounds, maxDepth=depth,
        stepSize=learning_rate, subsamplingRate=row_share, featureSubsetStrategy=str(column_share),
        minWeightFractionPerNode=min_weight_share, checkpointInterval=checkpoint_every, seed=seed,
        maxMemoryInMB=1024,
    )
    if validation:
        gbt = gbt.setValidationIndicatorCol(validation).setValidationTol(tolerance)
    return gbt


def penalised_trees(label: str = "isFraud", id: str = DEFAULT.id_col, **settings) -> PenalisedTrees:
    """Second-order boosted trees with L1/L2 penalties and least child weight; the full settings unless others are named."""
    return PenalisedTrees(TreeSettings(**settings), label, id)


def random_forest(
    label: str = "isFraud", trees: int = FOREST["trees"], depth: int = FOREST["depth"], seed: int = 6
) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed,
        maxMemoryInMB=1024,
    )


def scored_rows(model, prepared: DataFrame, id_col: str = "TransactionID", threshold: float = 0.5) -> DataFrame:
    """`id[, label], prediction_isFraud, fraud_probability`: the key travels with its score."""
    out = model.transform(prepared)
    kept = [c for c in prepared.schema.names if c not in ("features", "weight", "validation")]
    prob = vector_to_array(F.col("probability"))[1]
    return out.select(
        *kept, (prob > F.lit(threshold)).cast("int").alias("prediction_isFraud"), prob.alias("fraud_probability")
    )


@dataclass(frozen=True)
class FraudModel:
    """Fitted features, preparation and classifier that score raw rows."""

    features: G.FittedFeatures
    preparation: Preparation
    classifier: object
    cfg: FeatureConfig = DEFAULT
    metrics: dict = field(default_factory=dict)

    def predict_proba(
        self, df: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, history: DataFrame | None = None
    ) -> DataFrame:
        """One row per key with its label and probability. `history` holds the recent rows of the
        cards (id, time, amount, product, card columns), so that a small batch is no first payment."""
        policy = policy.settled(df)
        df = df.drop(self.cfg.target_col)
        df = read_once(df)
        rows = G.feature_chain(df, self.cfg, policy, self.features, training=False, history=history)
        return scored_rows(self.classifier, self.preparation.transform(rows, policy), self.cfg.id_col)

    def predict(self, df: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, history: DataFrame | None = None) -> DataFrame:
        return self.predict_proba(df, policy, history).select(self.cfg.id_col, "prediction_isFraud")

    def save(self, root: str, name: str = "FraudModel") -> int:
        """Save as the next version below `root`."""
        spark = self.features.profiles.table.sparkSession
        version = next_version(spark, root, name)
        path = version_path(root, name, version)
        self.features.profiles.save(f"{path}/profiles")
        self.preparation.save(f"{path}/preparation")
        if isinstance(self.classifier, PenalisedTreesModel):
            self.classifier.save(spark, f"{path}/classifier")
        else:
            self.classifier.write().overwrite().save(f"{path}/classifier")
        rates = self.features.rates
        if rates is not None:
            rates.full_table.write.mode("overwrite").parquet(f"{path}/rates")
        for part in ("repeats", "scores"):
            if getattr(self.features, part) is not None:
                getattr(self.features, part).write.mode("overwrite").parquet(f"{path}/{part}")
        info = {
            "kind": type(self.classifier).__name__,
            "rate_column": rates.col if rates else None,
            "rate_overall": rates.overall if rates else None,
            "metrics": self.metrics,
            "tables": [part for part in ("repeats", "scores") if getattr(self.features, part) is not None],
        }
        write_text(spark, f"{path}/model.json", json.dumps(info))
        return version

    @staticmethod
    def load(spark: SparkSession, root: str, name: str = "FraudModel", version="latest", cfg: FeatureConfig = DEFAULT) -> "FraudModel":
        path = version_path(root, name, resolve(spark, root, name, version))
        text = read_text(spark, f"{path}/model.json")
        if text is None:
            raise ModelNotFoundError(path)
        info = json.loads(text)
        kinds = {"GBTClassificationModel": GBTClassificationModel, "RandomForestClassificationModel": RandomForestClassificationModel, "PenalisedTreesModel": PenalisedTreesModel}
        rates = None
        if info["rate_column"]:
            table = spark.read.parquet(f"{path}/rates")
            size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("__n"), F.lit(0))).first()
            # Scoring never needs the per-fold rates.
            rates = A.TargetRates(info["rate_column"], table, table, info["rate_overall"], size[0], size[1])
        tables = {part: spark.read.parquet(f"{path}/{part}") for part in info.get("tables", [])}
        fitted = G.FittedFeatures(A.Profiles.load(spark, f"{path}/profiles"), rates, **tables)
        return FraudModel(
            fitted, Preparation.load(spark, f"{path}/preparation", cfg),
            kinds[info["kind"]].load(f"{path}/classifier"), cfg, info["metrics"],
        )


def predict_fraud(df: DataFrame, root: str, name: str = "FraudModel", version="latest") -> DataFrame:
    """Score rows with a stored model version."""
    model = require_model(FraudModel.load(df.sparkSession, root, name, version))
    return model.predict(require_rows(df))


def prepare_sets(
    train: DataFrame, test: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY
) -> tuple[G.FittedFeatures, Preparation, DataFrame, DataFrame]:
    """Fit features and preparation on the training rows and apply them to both sets. What looks
    backwards in time sees the rows of both."""
    policy = policy.settled(train)
    train, test = materialise(train), materialise(test)  # each is read for every statistic and as the other's history
    fitted = G.fit_features(train, cfg, policy=policy)
    past, later = _sequences(train, test, cfg, policy)
    base = G.chain_base(train, cfg, policy, fitted, test, past)
    base = replace(base, rows=materialise(base.rows, "zstd"))  # before the rows are widened: read for every fit and for the vectors
    train_rows = G.chain_rows(base, cfg, policy, fitted)
    preparation = fit_preparation(train_rows, cfg, policy=policy)
    large = any(n * policy.row_bytes > policy.broadcast_bytes for n in preparation.dictionaries.sizes.values())
    if large and unique_ids(train, cfg.id_col, policy):
        base = replace(base, rows=base.rows.repartition(cfg.id_col))  # codes are joined by id: exchanged while narrow
    train_set = materialise(preparation.transform(G.chain_rows(base, cfg, policy, fitted), policy, train_rows), "zstd")
    test_rows = G.chain_rows(G.chain_base(test, cfg, policy, fitted, train, later), cfg, policy, fitted, training=False)
    return fitted, preparation, train_set, materialise(preparation.transform(test_rows, policy), "zstd")


def _sequences(train: DataFrame, test: DataFrame, cfg: FeatureConfig, policy: SkewPolicy) -> tuple[DataFrame | None, DataFrame | None]:
    """The card sequences of both sets from one exchange of their rows together; none where an id stands in both, or where rows are worked on whole."""
    if set(train.columns) != set(test.columns):
        return None, None
    both = train.withColumn("__later", F.lit(False)).unionByName(test.withColumn("__later", F.lit(True)))
    if not G.sequence_apart(both.drop("__later"), cfg, policy) or not unique_ids(both, cfg.id_col, replace(policy, unique_ids=None)):
        return None, None
    rows = G.card_rows(both, cfg, policy, keep=["__later"])
    return rows.where("NOT __later").drop("__later"), rows.where("__later").drop("__later")


def fit_classifier(train: DataFrame, estimator, cfg: FeatureConfig = DEFAULT, positive_weight: float | None = None, validation_share: float = 0.0):
    """Fit on a prepared set with class weights and, if asked, a validation part."""
    weight = cfg.positive_weight if positive_weight is None else positive_weight
    rows = with_weights(train, cfg.target_col, weight)
    if validation_share > 0:
        held = hash_bucket(cfg.id_col, cfg.seed + 1) < F.lit(round(100_000 * validation_share))
        rows = rows.withColumn("validation", held)
        estimator = estimator.copy()
        estimator.setValidationIndicatorCol("validation")
    return estimator.fit(_checkpointed(rows))


def _checkpointed(rows: DataFrame) -> DataFrame:
    """Boosting cuts its lineage by checkpoints; without a folder Spark would silently not."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """Best number of rounds, and whether `patience` rounds without a better one have followed it."""
    best = min(range(len(losses)), key=losses.__getitem__)
    return best + 1, len(losses) - 1 - best >= patience


def fit_with_patience(
    train: DataFrame, estimator: GBTClassifier | PenalisedTrees, patience: int = BOOSTED["patience"], cfg: FeatureConfig = DEFAULT,
    positive_weight: float | None = None, validation_share: float = 0.1, first: int | None = None,
):
    """Boosted trees cut at the round after which the held rows have not become better for `patience` rounds.

    Penalised trees go on from stored margins, one tree after the other. Spark's own boosting cannot go on: its rounds are grown in stages (`first`,
    then twice as many) up to the estimator's number, and the same seed gives the same first trees, so the last fit holds the best rounds exactly.
    """
    weight = cfg.positive_weight if positive_weight is None else positive_weight
    held = hash_bucket(cfg.id_col, cfg.seed + 1) < F.lit(round(100_000 * validation_share))
    rows = with_weights(train, cfg.target_col, weight)
    if isinstance(estimator, PenalisedTrees):
        settings = replace(estimator.settings, patience=patience)
        return replace(estimator, settings=settings, validation="validation").fit(rows.withColumn("validation", held))
    rows = materialise(rows)
    used, unseen = _checkpointed(rows.where(~held)), rows.where(held)
    most = estimator.getMaxIter()
    rounds = min(most, first or 2 * patience)
    while True:
        model = estimator.copy({estimator.maxIter: rounds}).fit(used)
        best, settled = best_round(model.evaluateEachIteration(unseen), patience)
        if settled or rounds >= most:
            return model if best == rounds else estimator.copy({estimator.maxIter: best}).fit(used)
        rounds = min(most, 2 * rounds)


def evaluate_sets(
    model, sets: dict[str, DataFrame], cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """The same metric row for every named set."""
    scored = None
    for name, prepared in sets.items():
        part = scored_rows(model, prepared, cfg.id_col).withColumn("split", F.lit(name))
        scored = part if scored is None else scored.unionByName(part)
    # the metrics read the scores twice; the model runs once
    scored = materialise(scored.select("split", cfg.target_col, "prediction_isFraud", "fraud_probability"))
    return evaluate(scored, cfg.target_col, "prediction_isFraud", "fraud_probability", ["split"], policy)


def compare_models(train: DataFrame, test: DataFrame, estimators: dict[str, object], cfg: FeatureConfig = DEFAULT) -> DataFrame:
    """Fit every configuration and list its test metrics."""
    table = None
    for name, estimator in estimators.items():
        rows = evaluate_sets(fit_classifier(train, estimator, cfg), {"test": test}, cfg).withColumn("model", F.lit(name))
        table = rows if table is None else table.unionByName(rows)
    return table.select("model", "precision", "recall", "f1_score", "roc_auc", "average_precision")


def train_fraud_model(
    train: DataFrame, test: DataFrame, estimator=None, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY
) -> tuple[FraudModel, DataFrame, float]:
    """Fit everything on `train`; returns the model, its metric rows and the seconds spent."""
    started = time.monotonic()
    fitted, preparation, train_set, test_set = prepare_sets(train, test, cfg, policy)
    classifier = fit_classifier(train_set, estimator or boosted_trees(cfg.target_col), cfg)
    metrics = materialise(evaluate_sets(classifier, {"train": train_set, "test": test_set}, cfg))
    kept = {r["split"]: {k: v for k, v in r.asDict().items() if k != "split"} for r in metrics.collect()}
    return FraudModel(fitted, preparation, classifier, cfg, kept), metrics, time.monotonic() - started
