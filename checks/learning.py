"""M rows: splits, preparation, training, evaluation and scoring."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.config import DEFAULT
from ledgerlens.operators import split
from ledgerlens.operators.metrics import evaluate
from ledgerlens.operators.skew import SkewPolicy
from ledgerlens.plans import boosting as B2
from ledgerlens.plans import features as G
from ledgerlens.plans import model as M
from ledgerlens.plans import prepare as P
from ledgerlens.session import materialise, scratch_path
from ledgerlens.streaming import scoring, state

from .base import CARDED, ORACLE, B, R, check, digest_bucket, raw, txn
from .ordered import GAP, MEDIAN, PREV, VELOCITY

ID = "TransactionID"
ROUNDS, DEPTH = 3, 4  # of the models whose properties are checked against SQL; the models that are scored have the library's full settings


def sides(s, d, df=None):
    df = raw(s, d).drop("score") if df is None else df
    return split.stratified_split(df, ID, "isFraud", DEFAULT.test_size, DEFAULT.seed)


STRATIFIED = f"""
b AS (SELECT {ID}, isFraud, {digest_bucket(6, 100000)} AS b FROM txn),
n AS (SELECT isFraud, b, sum(count(*)) OVER (PARTITION BY isFraud ORDER BY b) AS upto, sum(count(*)) OVER (PARTITION BY isFraud) AS everything FROM b GROUP BY isFraud, b),
cut AS (SELECT isFraud, coalesce(max(CASE WHEN upto <= round(everything * CAST(0.2 AS DOUBLE)) THEN b END), -1) AS cut FROM n GROUP BY isFraud)"""


@check("m1_stratified_split", f"WITH {STRATIFIED} SELECT {ID}, {B('isFraud', 'isFraud')}, CASE WHEN b <= cut THEN 'test' ELSE 'train' END AS split FROM b JOIN cut USING (isFraud)")
def stratified(s, d):
    train, test = sides(s, d, txn(s, d).select(ID, "isFraud"))
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@check(
    "m2_three_way_split",
    f"SELECT CASE WHEN b < 82000 THEN 'train' WHEN b < 91000 THEN 'validation' ELSE 'test' END AS split, count(*) AS rows, {R('avg(isFraud)', 'positive_rate')} "
    f"FROM (SELECT isFraud, {digest_bucket(6, 100000)} AS b FROM txn) GROUP BY 1",
)
def three_way(s, d):
    parts = split.shares_split(txn(s, d).select(ID, "isFraud"), ID, (0.82, 0.09, 0.09))
    out = None
    for name, part in zip(("train", "validation", "test"), parts):
        part = part.withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return split.split_summary(out, "split", "isFraud")


FILL = ["card2", "addr1", "dist1", "dist2", "D1"]


@check("m3_constant_fill", f"SELECT {ID}, {', '.join(R(f'coalesce({c}, -999)', c) for c in FILL)} FROM txn")
def constant_fill(s, d):
    df = txn(s, d)
    return P.fill_constant(df, P.known_columns(df, FILL), DEFAULT.fill_value).select(ID, *FILL)


def _code(col):
    return (
        f"CASE WHEN {col} IS NULL THEN -999 ELSE coalesce((SELECT k FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM "
        f"(SELECT DISTINCT {col} AS v FROM txn WHERE {ID} % 5 <> 0 AND card4 IS DISTINCT FROM 'visa' AND {col} IS NOT NULL)) q WHERE q.v = txn.{col}), -1) END"
    )


@check("m4_ordinal_codes", f"SELECT {ID}, {', '.join(R(f'CAST({_code(c)} AS DOUBLE)', c) for c in ('ProductCD', 'card4', 'P_emaildomain'))} FROM txn")
def ordinal_codes(s, d):
    """Fitted on rows without one network, so that value is unseen later."""
    df, cols = txn(s, d), ["ProductCD", "card4", "P_emaildomain"]
    fitted = P.fit_dictionaries(df.where(f"{ID} % 5 <> 0 AND (card4 IS NULL OR card4 <> 'visa')"), cols)
    return P.encode(df, fitted, cols, DEFAULT.fill_value, DEFAULT.unknown_code).select(ID, *cols)


@check(
    "m4_ordinal_codes_many_values",
    f"SELECT {ID}, {R('CAST(dense_rank() OVER (ORDER BY k) - 1 AS DOUBLE)', 'k')} FROM (SELECT {ID}, concat('u', card1 * 100 + {ID} % 100) AS k FROM txn)",
)
def ordinal_codes_many(s, d):
    df = txn(s, d).selectExpr(ID, f"concat('u', card1 * 100 + {ID} % 100) AS k")
    return P.encode(df, P.fit_dictionaries(df, ["k"]), ["k"], -999.0, -1.0)


@check(
    "m4_ordinal_codes_many_dictionaries",
    "SELECT " + ", ".join([ID, *(R(f"CAST(CASE WHEN {c} IS NULL THEN -999 ELSE dense_rank() OVER (ORDER BY {c} NULLS LAST) - 1 END AS DOUBLE)", c) for c in "abc")])
    + f" FROM (SELECT {ID}, concat('u', card1 * 100 + {ID} % 100) AS a, concat('t', {ID} // 3) AS b, CASE WHEN {ID} % 7 > 0 THEN concat(card1, '_', coalesce(ProductCD, '-')) END AS c FROM txn)",
)
def ordinal_codes_long(s, d):
    """Dictionaries treated as beyond the broadcast limit: one long exchange for all of them."""
    df = txn(s, d).selectExpr(
        ID, f"concat('u', card1 * 100 + {ID} % 100) AS a", f"concat('t', {ID} DIV 3) AS b",
        f"CASE WHEN {ID} % 7 > 0 THEN concat(card1, '_', coalesce(ProductCD, '-')) END AS c",
    )
    fitted = P.fit_dictionaries(df, ["a", "b", "c"])
    return P.encode(df, fitted, ["a", "b", "c"], -999.0, -1.0, SkewPolicy(broadcast_bytes=0, hot_rows=1000))


V = ["V1", "V2", "V3", "V12", "V13", "V138"]


def _stage(s, d, column):
    df = txn(s, d)
    fitted, _ = P.fit_components(df, V, DEFAULT.pca_variance)
    out = fitted.transform(df).withColumn("a", vector_to_array(column))
    return out.select(ID, *[F.col("a")[i].alias(c) for i, c in enumerate(V)])


def _mean(c):
    return f"coalesce({c}, (SELECT avg({c}) FROM txn))"


@check("m5_mean_fill", f"SELECT {ID}, {', '.join(R(_mean(c), c) for c in V)} FROM txn")
def mean_fill(s, d):
    return _stage(s, d, "__v_raw")


@check(
    "m6_standardised",
    f"WITH f AS (SELECT {ID}, {', '.join(f'{_mean(c)} AS {c}' for c in V)} FROM txn) SELECT {ID}, "
    + ", ".join(R(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", c) for c in V) + " FROM f",
)
def standardised(s, d):
    return _stage(s, d, "__v_pop")


@check("m7_principal_components")
def principal_components(s, d):
    df = txn(s, d)
    fitted, kept = P.fit_components(df, V, DEFAULT.pca_variance)
    out = fitted.transform(df).withColumn("a", vector_to_array("pca"))
    return out.select(ID, *[F.col("a")[i].alias(f"pca{i}") for i in range(kept)])


def _spectral():
    """The covariance of the standardised columns entry by entry, then what must hold for the components."""
    filled = ", ".join(f"{_mean(c)} AS {c}" for c in V)
    entries = " UNION ALL ".join(
        f"SELECT 'covariance' AS part, {B(i, 'a')}, {B(j, 'b')}, {R(f'corr({x}, {y})', 'value')} FROM f" for i, x in enumerate(V) for j, y in enumerate(V)
    )
    unit = " UNION ALL ".join(f"SELECT 'product', {B(i, 'a')}, {B(j, 'b')}, CAST({int(i == j)} AS DOUBLE)" for i in range(len(V)) for j in range(len(V)))
    held = " UNION ALL ".join(f"SELECT '{name}', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS DOUBLE)" for name in ("share_reached", "one_less_is_too_few", "residual_small"))
    return f"WITH f AS (SELECT {filled} FROM txn) {entries} UNION ALL {unit} UNION ALL {held}"


@check("m7_components_checked", _spectral())
def components_checked(s, d):
    """Put together again from variances and directions, the components give the covariance that SQL computes; their products are those of unit vectors."""
    df = txn(s, d)
    fitted, kept = P.fit_components(df, V, DEFAULT.pca_variance)
    shares, w = fitted.stages[-2].explainedVariance.toArray(), fitted.stages[-2].pc.toArray()
    again, unit = (w * shares * len(V)) @ w.T, w.T @ w
    rows = [(part, i, j, float(m[i, j])) for part, m in (("covariance", again), ("product", unit)) for i in range(len(V)) for j in range(len(V))]
    held = {
        "share_reached": shares[:kept].sum() >= DEFAULT.pca_variance, "one_less_is_too_few": shares[: kept - 1].sum() < DEFAULT.pca_variance,
        "residual_small": P.components_residual(df, fitted, V) < 1e-6,
    }
    return s.createDataFrame(rows + [(k, 0, 0, float(v)) for k, v in held.items()], "part string, a long, b long, value double")


_CACHE: dict = {}


def prepared_sets(s, d):
    """Prepared training and test vectors; shared by the queries of one session."""
    key = (s.sparkContext.applicationId, d)
    if key not in _CACHE:
        train, test = sides(s, d)
        _CACHE[key] = M.prepare_sets(train, test)
    return _CACHE[key]


def classifier(s, d):
    """Boosted trees with the full settings (3000 rounds of depth 8); shared by the queries of one session."""
    key = (s.sparkContext.applicationId, d, "gbt")
    if key not in _CACHE:
        _CACHE[key] = M.fit_classifier(prepared_sets(s, d)[2], M.boosted_trees())
    return _CACHE[key]


def vectors(df):
    return df.select(ID, F.size(vector_to_array("features")).alias("width"), F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + F.abs(x)).alias("total"))


@check("m8_prepared_vectors")
def prepared_vectors(s, d):
    _, _, train, test = prepared_sets(s, d)
    return vectors(train).unionByName(vectors(test))


@check("m9_saved_preparation")
def saved_preparation(s, d):
    fitted, preparation, _, _ = prepared_sets(s, d)
    path = scratch_path(s, "preparation")
    preparation.save(path)
    again = P.Preparation.load(s, path)
    rows = G.feature_chain(sides(s, d)[1], fitted=fitted, training=False)
    return vectors(again.transform(rows))


@check("m10_boosted_trees")
def boosted(s, d):
    return M.scored_rows(classifier(s, d), prepared_sets(s, d)[3])


STUMP_COLUMNS = ("TransactionAmt", "card2", "card5", "addr1", "dist1", "D1", "V1", "V2", "V13")
STUMPS = B2.TreeSettings(rounds=3, depth=1, learning_rate=0.3, row_share=1.0, column_share=1.0)


def _round(k: int) -> str:
    """CTEs of one round in SQL: derivatives from the margins, sums per value, the best cut, leaf values and new margins."""
    half = lambda g: f"(sign({g}) * greatest(abs({g}) - 1, 0))"
    score = lambda g, h: f"({half(g)} ** 2 / ({h} + 2))"
    leaf = lambda g, h: f"(-0.3 * {half(g)} / ({h} + 2))"
    return f"""
    d{k} AS (SELECT {ID}, w * (1 / (1 + exp(-m)) - y) AS g, w * (1 / (1 + exp(-m))) * (1 - 1 / (1 + exp(-m))) AS h FROM m{k}),
    v{k} AS (SELECT name, value, sum(g) AS g, sum(h) AS h FROM long JOIN d{k} USING ({ID}) GROUP BY 1, 2),
    u{k} AS (SELECT name, value, sum(g) OVER (PARTITION BY name ORDER BY value) AS lg, sum(h) OVER (PARTITION BY name ORDER BY value) AS lh,
      sum(g) OVER (PARTITION BY name) AS g, sum(h) OVER (PARTITION BY name) AS h FROM v{k}),
    b{k} AS (SELECT {k} AS round, name, value AS threshold, {score('lg', 'lh')} + {score('(g - lg)', '(h - lh)')} - {score('g', 'h')} AS gain,
      {leaf('lg', 'lh')} AS left_value, {leaf('(g - lg)', '(h - lh)')} AS right_value FROM u{k} WHERE lh >= 5 AND h - lh >= 5 ORDER BY gain DESC LIMIT 1),
    m{k + 1} AS (SELECT m.{ID}, y, w, m + CASE WHEN long.value <= threshold THEN left_value ELSE right_value END AS m FROM m{k} m JOIN long USING ({ID}) JOIN b{k} ON long.name = b{k}.name)"""


_LONG = " UNION ALL ".join(f"SELECT {ID}, '{c}' AS name, coalesce(CAST({c} AS DOUBLE), CAST(-999 AS DOUBLE)) AS value FROM few" for c in STUMP_COLUMNS)
STUMP_SQL = (
    f"WITH few AS (SELECT * REPLACE (CAST(floor(TransactionAmt / 40) AS DOUBLE) AS TransactionAmt, dist1 % 200 AS dist1) FROM txn), long AS ({_LONG}), "
    f"m0 AS (SELECT {ID}, CAST(isFraud AS DOUBLE) AS y, CASE WHEN isFraud = 1 THEN CAST(27 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS w, CAST(0 AS DOUBLE) AS m FROM txn), "
    + ",".join(_round(k) for k in range(3))
    + f" SELECT round, name, {R('threshold', 'threshold')}, {R('gain', 'gain')}, {R('left_value', 'left_value')}, {R('right_value', 'right_value')} FROM (SELECT * FROM b0 UNION ALL SELECT * FROM b1 UNION ALL SELECT * FROM b2)"
)


@check("m10_penalised_rounds", STUMP_SQL)
def penalised_rounds(s, d):
    """Three rounds of one split each over columns with few values: the cut, its gain and both leaf values, penalties included."""
    few = txn(s, d).withColumn("TransactionAmt", F.floor(F.col("TransactionAmt") / 40).cast("double")).withColumn("dist1", F.col("dist1") % 200)
    features = array_to_vector(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(-999.0)) for c in STUMP_COLUMNS]))
    rows = M.with_weights(few.select(ID, "isFraud", features.alias("features")), "isFraud", DEFAULT.positive_weight)
    trees = M.PenalisedTrees(STUMPS).fit(rows).trees
    out = [(k, STUMP_COLUMNS[t.feature[0]], float(t.threshold[0]), float(t.gain[0]), float(t.value[1]), float(t.value[2])) for k, t in enumerate(trees)]
    return s.createDataFrame(out, "round int, name string, threshold double, gain double, left_value double, right_value double")


@check("m10_penalised_trees")
def penalised(s, d):
    """The full settings: 3000 rounds of depth 8 with penalties and shares."""
    _, _, train, test = prepared_sets(s, d)
    return M.scored_rows(M.fit_classifier(train, M.penalised_trees()), test)


@check("m11_early_stopping")
def early_stopping(s, d):
    _, _, train, test = prepared_sets(s, d)
    model = M.fit_with_patience(train, M.penalised_trees(rounds=8, depth=DEPTH, learning_rate=0.3), patience=2)
    return M.scored_rows(model, test).withColumn("trees", F.lit(model.getNumTrees))


@check("m11_best_round", "SELECT CAST(1 AS BIGINT) AS best_round_found, CAST(1 AS BIGINT) AS losses_agree")
def best_round_found(s, d):
    """The measures kept while growing equal those of the first k trees on the held rows, and the trees end at the best one."""
    _, _, train, _ = prepared_sets(s, d)
    model = M.fit_with_patience(train, M.penalised_trees(rounds=6, depth=3, learning_rate=0.5, watch="loss"), patience=2)
    held = train.where(M.hash_bucket(ID, DEFAULT.seed + 1) < 10_000)
    margins = [B2.PenalisedTreesModel(model.trees[:k]).margin(F.col("features")).alias(f"m{k}") for k in range(1, model.getNumTrees + 1)]
    signed = lambda m: F.when(F.col("isFraud") == 1, -F.col(m)).otherwise(F.col(m))
    again = held.select("isFraud", *margins).agg(*[F.avg(F.log1p(F.exp(signed(f"m{k}")))).alias(f"m{k}") for k in range(1, model.getNumTrees + 1)])
    gaps = [F.abs(F.col(f"m{k + 1}") - F.lit(v)) for k, v in enumerate(model.measures[: model.getNumTrees])]
    found = M.best_round(model.measures, 2)[0] == model.getNumTrees
    return again.select(F.lit(int(found)).alias("best_round_found"), (F.greatest(*gaps, F.lit(0.0)) < 1e-9).cast("bigint").alias("losses_agree"))


@check("m12_class_weights", f"SELECT {ID}, {R('CASE WHEN isFraud = 1 THEN 27 ELSE 1 END', 'weight')} FROM txn")
def class_weights(s, d):
    return M.with_weights(txn(s, d), "isFraud", DEFAULT.positive_weight).select(ID, "weight")


@check("m13_random_forest")
def forest(s, d):
    _, _, train, test = prepared_sets(s, d)
    weight = M.balanced_weight(train, "isFraud")
    return M.scored_rows(M.fit_classifier(train, M.random_forest(trees=5, depth=5), positive_weight=weight), test)


@check("m14_model_comparison")
def comparison(s, d):
    """Both with the full settings: 3000 rounds of depth 8, and 200 trees of depth 20."""
    _, _, train, test = prepared_sets(s, d)
    return M.compare_models(train, test, {"boosted": M.boosted_trees(), "forest": M.random_forest()})


_TEST_ROWS = f"SELECT count(*) AS rows, {B('sum(isFraud)', 'positives')} FROM b JOIN cut USING (isFraud) WHERE b <= cut"


@check("m13_forest_probabilities", f"WITH {STRATIFIED} SELECT *, CAST(1 AS BIGINT) AS mean_of_trees, CAST(1 AS BIGINT) AS decided_by_half FROM ({_TEST_ROWS})")
def forest_probabilities(s, d):
    """The forest's probability is the mean of its trees' leaf shares, each tree applied by itself to the whole test part."""
    _, _, train, test = prepared_sets(s, d)
    model = M.fit_classifier(train, M.random_forest(trees=5, depth=5), positive_weight=M.balanced_weight(train, "isFraud"))
    scored = M.scored_rows(model, test).select(ID, "isFraud", "prediction_isFraud", "fraud_probability")
    alone = None
    for tree in model.trees:
        one = tree.transform(test).select(ID, vector_to_array("probability")[1].alias("p"))
        alone = one if alone is None else alone.unionByName(one)
    both = scored.join(alone.groupBy(ID).agg(F.avg("p").alias("p")), ID, "left")
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("isFraud").alias("positives"),
        (F.max(F.abs(F.coalesce("p", F.lit(9.0)) - F.col("fraud_probability"))) < 1e-9).cast("bigint").alias("mean_of_trees"),
        F.min((F.col("prediction_isFraud") == (F.col("fraud_probability") > 0.5).cast("int")).cast("bigint")).alias("decided_by_half"),
    )


@check(
    "m14_comparison_recomputed",
    f"WITH {STRATIFIED} SELECT model, t.*, CAST(1 AS BIGINT) AS rates_agree, CAST(1 AS BIGINT) AS auc_agrees FROM ({_TEST_ROWS}) t, (VALUES ('boosted'), ('forest')) m(model)",
)
def comparison_recomputed(s, d):
    """The listed metrics of every configuration against counts over its scored test rows; AUC against mid-ranks of the scores."""
    _, _, train, test = prepared_sets(s, d)
    estimators = {"boosted": M.boosted_trees(rounds=ROUNDS, depth=DEPTH), "forest": M.random_forest(trees=5, depth=5)}
    out = None
    for name, estimator in estimators.items():
        rows = M.scored_rows(M.fit_classifier(train, estimator), test).select("isFraud", "prediction_isFraud", "fraud_probability")
        out = rows.withColumn("model", F.lit(name)) if out is None else out.unionByName(rows.withColumn("model", F.lit(name)))
    # equal scores are one row, so ranks are summed over distinct scores of a model
    levels = out.groupBy("model", "fraud_probability").agg(
        F.count(F.lit(1)).alias("n"), F.sum("isFraud").alias("pos"), F.sum(F.col("isFraud") * F.col("prediction_isFraud")).alias("tp"), F.sum("prediction_isFraud").alias("said"),
    )
    below = Window.partitionBy("model").orderBy("fraud_probability")
    ranked = levels.withColumn("rank", F.sum("n").over(below) - (F.col("n") - 1) / 2)
    counted = ranked.groupBy("model").agg(*[F.sum(c).alias(c) for c in ("n", "pos", "tp", "said")], F.sum(F.col("pos") * F.col("rank")).alias("ranks")).selectExpr(
        "model", "n AS rows", "pos AS positives", "coalesce(try_divide(tp, said), 0D) AS p", "coalesce(try_divide(tp, pos), 0D) AS r", "coalesce(try_divide(2 * tp, said + pos), 0D) AS f",
        "try_divide(ranks - pos * (pos + 1) / 2, pos * (n - pos)) AS auc",
    )
    same = "CAST({} AS BIGINT)"
    return counted.join(M.compare_models(train, test, estimators), "model", "left").selectExpr(
        "model", "rows", "positives", same.format("abs(p - precision) < 1e-9 AND abs(r - recall) < 1e-9 AND abs(f - f1_score) < 1e-9") + " AS rates_agree",
        same.format("abs(auc - roc_auc) < 1e-9") + " AS auc_agrees",
    )


@check("m15_metrics_by_split")
def metrics_by_split(s, d):
    _, _, train, test = prepared_sets(s, d)
    return M.evaluate_sets(classifier(s, d), {"train": train, "test": test})


_TEXT_SPLIT = f"CASE WHEN {ID} % 5 = 0 THEN 'test' ELSE 'train' END"
_PRED = f"p AS (SELECT *, {_TEXT_SPLIT} AS split, CASE WHEN score > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS pred FROM txn)"


@check(
    "m15_score_metrics_by_split",
    f"""WITH {_PRED}, m AS (SELECT split, {B('sum((1 - isFraud) * (1 - pred))', 'true_negatives')}, {B('sum((1 - isFraud) * pred)', 'false_positives')},
    {B('sum(isFraud * (1 - pred))', 'false_negatives')}, {B('sum(isFraud * pred)', 'true_positives')} FROM p GROUP BY split),
    g AS (SELECT split, score, sum(isFraud) AS pos, sum(1 - isFraud) AS neg FROM p GROUP BY 1, 2),
    k AS (SELECT *, sum(pos) OVER (PARTITION BY split ORDER BY score DESC) AS tp, sum(neg) OVER (PARTITION BY split ORDER BY score DESC) AS fp FROM g),
    q AS (SELECT split, {R('sum(neg * (tp - pos / CAST(2 AS DOUBLE))) / (CAST(sum(pos) AS DOUBLE) * sum(neg))', 'roc_auc')}, {R('sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / sum(pos)', 'average_precision')} FROM k GROUP BY split)
    SELECT m.*, {R('(true_positives + true_negatives) / CAST(true_positives + true_negatives + false_positives + false_negatives AS DOUBLE)', 'accuracy')},
    {R('coalesce(true_positives / CAST(nullif(true_positives + false_positives, 0) AS DOUBLE), 0)', 'precision')},
    {R('coalesce(true_positives / CAST(nullif(true_positives + false_negatives, 0) AS DOUBLE), 0)', 'recall')},
    {R('coalesce(2 * true_positives / CAST(nullif(2 * true_positives + false_positives + false_negatives, 0) AS DOUBLE), 0)', 'f1_score')}, roc_auc, average_precision FROM m JOIN q USING (split)""",
)
def score_metrics_by_split(s, d):
    df = txn(s, d).withColumn("split", F.expr(f"IF({ID} % 5 = 0, 'test', 'train')")).withColumn("pred", F.expr("CAST(score > 0.5D AS INT)"))
    return evaluate(df, "isFraud", "pred", "score", ["split"])


_NULL_PRED = _PRED.replace(_TEXT_SPLIT, f"CASE WHEN {ID} % 5 = 0 THEN 'test' WHEN {ID} % 5 = 1 THEN NULL ELSE 'train' END")
_BY_SPLIT = ORACLE["m15_score_metrics_by_split"]
_START = _BY_SPLIT.index(_PRED)


@check("m15_metrics_with_a_missing_group", "WITH " + _BY_SPLIT[_START:].replace(_PRED, _NULL_PRED).replace("JOIN q USING (split)", "JOIN q ON m.split IS NOT DISTINCT FROM q.split").replace("SELECT m.*,", "SELECT m.*,"))
def metrics_with_a_missing_group(s, d):
    df = txn(s, d).withColumn("split", F.expr(f"CASE {ID} % 5 WHEN 0 THEN 'test' WHEN 1 THEN NULL ELSE 'train' END")).withColumn("pred", F.expr("CAST(score > 0.5D AS INT)"))
    return evaluate(df, "isFraud", "pred", "score", ["split"])


def fraud_model(s, d):
    fitted, preparation, _, _ = prepared_sets(s, d)
    return M.FraudModel(fitted, preparation, classifier(s, d))


@check("m16_predictions")
def predicted(s, d):
    train, test = sides(s, d)
    return fraud_model(s, d).predict(test, history=train)


@check(
    "m16_history_features",
    f"WITH {CARDED}, {STRATIFIED}, h AS (SELECT {ID}, {PREV} AS prev, {MEDIAN} AS med, {GAP} AS gap, {VELOCITY} AS velocity FROM c) "
    f"SELECT h.{ID}, {R('prev', 'prev_amount')}, {R('med', 'rolling_median_amt')}, {B('gap', 'Transaction_time_gap')}, {B('velocity', 'Transaction_cnt_1hr')} "
    f"FROM h JOIN b USING ({ID}) JOIN cut USING (isFraud) WHERE b.b <= cut.cut",
)
def history_features(s, d):
    """The test side looks back into all earlier rows of its cards, not only into its own."""
    train, test = sides(s, d)
    out = G.feature_chain(test, fitted=G.fit_features(train), training=False, history=train)
    return out.select(ID, "prev_amount", "rolling_median_amt", "Transaction_time_gap", "Transaction_cnt_1hr")


@check("m17_probabilities")
def probabilities(s, d):
    return fraud_model(s, d).predict_proba(raw(s, d).drop("score"))


@check("m18_stored_model_predictions")
def stored_model(s, d):
    root = scratch_path(s, "models")
    fraud_model(s, d).save(root)
    return M.predict_fraud(sides(s, d)[1].drop("isFraud"), root)


@check(
    "m19_split_summary",
    f"SELECT {_TEXT_SPLIT} AS split, count(*) AS rows, {R('avg(isFraud)', 'positive_rate')} FROM txn GROUP BY 1",
)
def summary(s, d):
    return split.split_summary(txn(s, d).withColumn("split", F.expr(f"IF({ID} % 5 = 0, 'test', 'train')")), "split", "isFraud")


# ---- properties of fitted models that SQL can state ---------------------------------------------

TEST_SIDE = f"WITH {STRATIFIED} SELECT {ID}, CAST(1 AS BIGINT) AS same FROM b JOIN cut USING (isFraud) WHERE b <= cut"


def equal_scores(a, b):
    """One row a key: 1 if both give it the same label and probability."""
    b = b.select(ID, F.col("prediction_isFraud").alias("__l"), F.col("fraud_probability").alias("__p"))
    same = (F.col("prediction_isFraud") == F.col("__l")) & (F.abs(F.col("fraud_probability") - F.col("__p")) < 1e-9)
    return a.join(b, ID, "full").select(ID, F.coalesce(same, F.lit(False)).cast("bigint").alias("same"))


@check("m9_loaded_preparation_equals_memory", TEST_SIDE)
def loaded_preparation(s, d):
    fitted, preparation, _, test = prepared_sets(s, d)
    path = scratch_path(s, "preparation")
    preparation.save(path)
    train, side = sides(s, d)
    rows = G.feature_chain(side, fitted=fitted, training=False, history=train)
    again = vectors(P.Preparation.load(s, path).transform(rows)).withColumnsRenamed({"width": "w", "total": "t"})
    same = (F.col("width") == F.col("w")) & (F.abs(F.col("total") - F.col("t")) < 1e-6)
    return vectors(test).join(again, ID, "full").select(ID, F.coalesce(same, F.lit(False)).cast("bigint").alias("same"))


@check("m17_probability_range", f"SELECT {ID}, CAST(1 AS BIGINT) AS valid FROM txn")
def probability_range(s, d):
    valid = F.col("fraud_probability").between(0, 1) & ((F.col("fraud_probability") > 0.5).cast("int") == F.col("prediction_isFraud"))
    return fraud_model(s, d).predict_proba(raw(s, d).drop("score")).select(ID, valid.cast("bigint").alias("valid"))


@check("m18_stored_model_equals_memory", TEST_SIDE)
def stored_equals_memory(s, d):
    root = scratch_path(s, "models")
    model = fraud_model(s, d)
    model.save(root)
    train, test = sides(s, d)
    return equal_scores(M.FraudModel.load(s, root).predict_proba(test, history=train), model.predict_proba(test, history=train))


# ---- continuous scoring with a stored model ------------------------------------------------------


@check("t12_stored_model_stream", f"WITH {STRATIFIED} SELECT b.{ID}, CAST(1 AS BIGINT) AS same FROM b JOIN cut USING (isFraud) WHERE b <= cut AND {ID} % 50 <> 0")
def stored_model_stream(s, d):
    """Test rows arrive in four files by time, some with an unreadable amount. A loaded model scores them with the state of their cards; every
    probability equals that of one batch over all good rows, so previous amounts, medians, gaps, fills and hourly counts reach across files."""
    root, inbox, out, ck = (scratch_path(s, f"cards-{n}") for n in ("models", "in", "out", "ck"))
    fraud_model(s, d).save(root)
    model = M.FraudModel.load(s, root)
    test = materialise(sides(s, d)[1].drop("isFraud"))  # read for the cuts, by every file and by the batch
    expected = test.schema
    cuts = test.approxQuantile("TransactionDT", [0.25, 0.5, 0.75], 0.0)
    raw_rows = test.withColumn("TransactionAmt", F.expr(f"IF({ID} % 50 = 0, 'garbage', CAST(TransactionAmt AS STRING))"))
    for a, b in zip([float("-inf"), *cuts], [*cuts, float("inf")]):
        slice_ = raw_rows.where((F.col("TransactionDT") > a) & (F.col("TransactionDT") <= b))
        slice_.coalesce(1).write.mode("append").parquet(inbox)
    stream = scoring.arriving_rows(s, inbox, raw_rows.schema, files_per_batch=1)
    state.score_cards(stream, expected, lambda rows, history: model.predict_proba(rows, history=history), out, ck, available_now=True).awaitTermination()
    return equal_scores(s.read.parquet(f"{out}/predictions").drop("batch"), model.predict_proba(test.where(f"{ID} % 50 <> 0")))
