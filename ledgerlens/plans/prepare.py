"""Fitted preparation: constant fill, ordinal codes, and scaled principal components."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, ElementwiseProduct, Imputer, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, FeatureConfig
from ..functions.sqltext import add, lit, map_of
from ..operators.joins import unique_ids
from ..operators.ordered import dense_position
from ..operators.skew import DEFAULT_POLICY, SkewPolicy, hashed, lookup, skewed_lookup
from ..operators.stats import profile_table
from ..session import materialise, read_once
from ..sources.files import read_text, write_text

_INLINE = 64  # dictionaries up to this size become a constant in the plan


# ---- constant fill -------------------------------------------------------------------------

def known_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns with at least one value; the others carry nothing to learn from."""
    if not cols:
        return []
    seen = df.agg(*[F.count(c).alias(f"__n{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if seen[i]]


def fill_constant(df: DataFrame, cols: list[str], value: float) -> DataFrame:
    """Numbers as doubles with missing replaced."""
    return add(df, {c: f"coalesce(CAST(`{c}` AS DOUBLE), {lit(float(value))})" for c in cols})


# ---- ordinal codes -------------------------------------------------------------------------

@dataclass(frozen=True)
class Dictionaries:
    """`table(name, value, code, n)`: codes 0.. in the order of the values, per column, and the
    rows holding each value."""

    table: DataFrame
    sizes: dict
    inline: dict
    totals: dict


def _dictionaries(table: DataFrame, cols: list[str]) -> Dictionaries:
    found = table.groupBy("name").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows")).collect()
    sizes = {r["name"]: r["values"] for r in found}
    few = [c for c in cols if sizes.get(c, 0) <= _INLINE]
    inline: dict = {c: {} for c in few}
    for r in table.where(F.col("name").isin(few)).collect():  # at most 64 rows per column
        inline[r["name"]][r["value"]] = r["code"]
    return Dictionaries(table, {c: sizes.get(c, 0) for c in cols}, inline, {r["name"]: r["rows"] for r in found})


def fit_dictionaries(df: DataFrame, cols: list[str], policy: SkewPolicy = DEFAULT_POLICY) -> Dictionaries:
    """Distinct values of all columns in one shuffle, numbered in order. Nothing is gathered on
    the driver, so columns with as many values as rows are fine."""
    policy = policy.settled(df)
    values = profile_table(df, cols).where(F.col("name").isin(list(cols))).select("name", "value", "n")
    coded = dense_position(values, ["value"], ["name"], "code", policy=policy)
    return _dictionaries(materialise(coded.withColumn("code", (F.col("code") - 1).cast("double"))), list(cols))


def encode(
    df: DataFrame, fitted: Dictionaries, cols: list[str], missing: float, unknown: float,
    policy: SkewPolicy = DEFAULT_POLICY, spread: str = "TransactionID", source: DataFrame | None = None,
) -> DataFrame:
    """Replace text by its code; missing and unseen values get their own codes.

    Dictionaries of counted size are broadcast. Several larger ones, or one for a wide frame, are looked up in one long exchange of (id, column, value)
    and folded back once, where ids are known to be unique; else each is a join of its own. `source`, if given, holds the same rows and gives the ids and values at less cost.
    """
    here = set(df.schema.names)
    constant, joined = {}, []
    for c in cols:
        text = f"CAST(`{c}` AS STRING)" if c in here else "CAST(NULL AS STRING)"
        if c in fitted.inline:
            codes = {k: float(v) for k, v in fitted.inline[c].items()}
            found = f"try_element_at({map_of(codes)}, {text})" if codes else "CAST(NULL AS DOUBLE)"
            constant[c] = f"CASE WHEN {text} IS NULL THEN {lit(missing)} ELSE coalesce({found}, {lit(unknown)}) END"
        else:
            joined.append(c)
            constant[c] = text
    large = [c for c in joined if fitted.sizes[c] * policy.row_bytes > policy.broadcast_bytes]
    if len(large) + (len(here) > policy.narrow_over) < 2 or spread not in here:
        large = []
    df = add(df, constant)
    if large:
        keys = read_once((df if source is None else add(source, constant)).select(spread, *joined))  # only these are stored: the rows stay in one plan, which may have them by id already
        if not unique_ids(keys, spread, policy):
            large = []
    for c in [] if large else joined:
        table = fitted.table.where(F.col("name") == c).selectExpr(f"value AS `{c}`", f"code AS `__c_{c}`", "n AS __n")
        if fitted.sizes[c] * policy.row_bytes <= policy.broadcast_bytes or spread not in here:
            df = lookup(df, table.drop("__n"), c, policy, fitted.sizes[c])
        else:
            df = skewed_lookup(df, table, [c], "__n", fitted.totals[c], spread, policy).drop("__n")
    if large:
        df = _encode_long(df, keys, fitted, joined, large, spread, policy)
    final = {
        c: f"CASE WHEN `{c}` IS NULL THEN {lit(missing)} ELSE coalesce(`__c_{c}`, {lit(unknown)}) END" for c in joined
    }
    return add(df, final, drop=[f"__c_{c}" for c in joined])


def _encode_long(df: DataFrame, keys: DataFrame, fitted: Dictionaries, joined: list[str], cols: list[str], id_col: str, policy: SkewPolicy) -> DataFrame:
    """Adds `__c_<column>` for many dictionaries: the wide rows are exchanged once, whatever the number of columns. The other dictionaries of the
    `joined` columns are broadcast to the keys too, since a wide row is copied for every one of them.

    Only ids and values (`keys`) travel to the dictionaries; frequent values are looked up apart (`skewed_lookup`). Ids must be present and unique.
    """
    pairs = ", ".join(f"struct({lit(c)} AS name, `{c}` AS value)" for c in cols)
    long = keys.selectExpr(f"`{id_col}`", f"inline(filter(array({pairs}), p -> p.value IS NOT NULL))")
    table = fitted.table.where(F.col("name").isin(cols)).selectExpr("name", "value", "code AS __code", "n AS __n")
    coded = skewed_lookup(long, table, ["name", "value"], "__n", sum(fitted.totals.get(c, 0) for c in cols), id_col, policy)
    folded = coded.groupBy(id_col).agg(*[F.max(F.when(F.col("name") == c, F.col("__code"))).alias(f"__c_{c}") for c in cols])
    rows, small = keys.count(), [c for c in joined if c not in cols]
    if small:
        found = keys.select(id_col, *small)
        for c in small:
            table = fitted.table.where(F.col("name") == c).selectExpr(f"value AS `{c}`", f"code AS `__c_{c}`")
            found = lookup(found, table, c, policy, fitted.sizes[c])
        df = df.join(hashed(found.select(id_col, *[f"__c_{c}" for c in small]), policy, rows), id_col, "left")
    return df.join(hashed(folded, policy, rows), id_col, "left")


# ---- principal components --------------------------------------------------------------------

def fit_components(df: DataFrame, cols: list[str], variance: float) -> tuple[PipelineModel, int]:
    """Mean fill, standardisation with the population deviation, and the fewest principal
    components explaining `variance`. Returns the fitted stages and the number kept."""
    n = df.count()
    filled = [f"__fill_{c}" for c in cols]
    numbers = add(df, {c: f"CAST(`{c}` AS DOUBLE)" for c in cols})
    correction = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    stages = [
        Imputer(strategy="mean", inputCols=cols, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="__v_raw"),
        StandardScaler(inputCol="__v_raw", outputCol="__v_std", withMean=True, withStd=True),
        # Variances go with one constant, so it may be applied after the components are found.
        ElementwiseProduct(inputCol="__v_std", outputCol="__v_pop", scalingVec=Vectors.dense([correction] * len(cols))),
        PCA(k=len(cols), inputCol="__v_pop", outputCol="__v_all"),
    ]
    model = Pipeline(stages=stages).fit(numbers)
    explained, kept = 0.0, 0
    for share in model.stages[-1].explainedVariance.toArray():
        explained, kept = explained + float(share), kept + 1
        if explained >= variance - 1e-12:
            break
    slicer = VectorSlicer(inputCol="__v_all", outputCol="pca", indices=list(range(kept)))
    return PipelineModel(stages=[*model.stages, slicer]), kept


def components_residual(df: DataFrame, fitted: PipelineModel, cols: list[str]) -> float:
    """How far the components are from eigenvectors: largest entry of C w - v w over all of them, with C the covariance of the standardised columns
    and v the variance of the component's scores. C w is the covariance of the columns with the scores, one aggregate over all rows."""
    prepared = fitted.transform(add(df, {c: f"CAST(`{c}` AS DOUBLE)" for c in cols}))
    both = prepared.select(vector_to_array("__v_pop").alias("x"), vector_to_array("__v_all").alias("w"))
    p = len(cols)
    terms = [F.expr(f"covar_pop(x[{i}], w[{k}])") for i in range(p) for k in range(p)] + [F.expr(f"var_pop(w[{k}])") for k in range(p)]
    found = np.array([v if v is not None else 0.0 for part in range(0, len(terms), 1000) for v in both.agg(*terms[part : part + 1000]).first()])
    crossed, variances = found[: p * p].reshape(p, p), found[p * p :]
    return float(np.abs(crossed - fitted.stages[-2].pc.toArray() * variances).max())


# ---- all of it -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Preparation:
    """Everything fitted on training rows that turns features into one vector per key."""

    numbers: list
    texts: list
    v_cols: list
    dictionaries: Dictionaries
    components: PipelineModel | None
    kept_components: int
    cfg: FeatureConfig

    @property
    def width(self) -> int:
        return len(self.numbers) + len(self.texts) + self.kept_components

    def transform(self, df: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, source: DataFrame | None = None) -> DataFrame:
        """`id, features[, target]`: key and label stay in the row with their vector. `source`: as in `encode`."""
        cfg = self.cfg
        here = set(df.schema.names)
        absent = [c for c in [*self.numbers, *self.v_cols] if c not in here]
        df = add(df, {c: "CAST(NULL AS DOUBLE)" for c in absent})
        keep = [c for c in (cfg.id_col, cfg.target_col) if c in here]
        df = fill_constant(df, [c for c in self.numbers if c not in keep], cfg.fill_value)
        df = encode(df, self.dictionaries, self.texts, cfg.fill_value, cfg.unknown_code, policy, cfg.id_col, source)
        parts = [*self.numbers, *self.texts]
        if self.components is not None:
            df = add(df, {c: f"CAST(`{c}` AS DOUBLE)" for c in self.v_cols})
            df = self.components.transform(df)
            parts.append("pca")
        out = VectorAssembler(inputCols=parts, outputCol="features").transform(df)
        return out.select(*keep, "features")

    def save(self, path: str) -> None:
        spark = self.dictionaries.table.sparkSession
        self.dictionaries.table.write.mode("overwrite").parquet(f"{path}/dictionaries")
        if self.components is not None:
            self.components.write().overwrite().save(f"{path}/components")
        spec = {
            "numbers": self.numbers, "texts": self.texts, "v_cols": self.v_cols,
            "kept_components": self.kept_components,
        }
        write_text(spark, f"{path}/spec.json", json.dumps(spec))

    @staticmethod
    def load(spark: SparkSession, path: str, cfg: FeatureConfig = DEFAULT) -> "Preparation":
        text = read_text(spark, f"{path}/spec.json")
        if text is None:
            raise FileNotFoundError(path)
        spec = json.loads(text)
        table = spark.read.parquet(f"{path}/dictionaries")
        components = PipelineModel.load(f"{path}/components") if spec["v_cols"] else None
        return Preparation(
            spec["numbers"], spec["texts"], spec["v_cols"], _dictionaries(table, spec["texts"]),
            components, spec["kept_components"], cfg,
        )


def fit_preparation(
    train: DataFrame, cfg: FeatureConfig = DEFAULT, exclude=("score",), exclude_keys: bool = True,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> Preparation:
    """Fit on training rows only. The key is no feature unless `exclude_keys` is off."""
    policy = policy.settled(train)
    hidden = {cfg.target_col, *exclude} | ({cfg.id_col} if exclude_keys else set())
    fields = [f for f in train.schema.fields if f.name not in hidden]
    numbers = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    present = known_columns(train, numbers)
    v_cols = [c for c in present if c.startswith("V")]
    plain = [c for c in present if not c.startswith("V")]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    dictionaries = fit_dictionaries(train, texts, policy)
    components, kept = fit_components(train, v_cols, cfg.pca_variance) if v_cols else (None, 0)
    return Preparation(plain, texts, v_cols, dictionaries, components, kept, cfg)
