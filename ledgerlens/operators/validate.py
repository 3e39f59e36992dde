"""Alignment, cleaning and validation of incoming rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import NULL_TOKENS
from ..functions import text as X
from ..functions.scalars import to_number
from ..functions.sqltext import add, lit
from .ordered import dense_position
from .skew import DEFAULT_POLICY, SkewPolicy


class ValidationError(ValueError):
    """Rows do not fit the expected types; carries up to ten examples."""


class EmptyBatchError(ValueError):
    """There is nothing to score."""


class MissingModelError(RuntimeError):
    """No fitted model is available."""


def normalise_headers(df: DataFrame) -> DataFrame:
    """`id-01` becomes `id_01`."""
    return df.toDF(*[re.sub(r"-", "_", c.strip()) for c in df.schema.names])


def canonical_headers(df: DataFrame, expected) -> DataFrame:
    """Rename columns to their expected spelling regardless of case and outer blanks; unknown
    names stay as they are. Two columns for one expected name are an error."""
    known = {c.lower(): c for c in expected}
    renamed = [known.get(c.strip().lower(), c) for c in df.schema.names]
    repeated = sorted({c for c in renamed if renamed.count(c) > 1})
    if repeated:
        raise ValidationError(f"several columns map to {', '.join(repeated)}")
    return df.toDF(*renamed)


def clean_null_tokens(df: DataFrame, tokens=NULL_TOKENS) -> DataFrame:
    """Text that only spells a missing value becomes null in every text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return add(df, {c: X.clean_null_token(f"`{c}`", tokens) for c in texts})


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are null, never NaN."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return add(df, {c: f"CASE WHEN NOT isnan(`{c}`) THEN `{c}` END" for c in numbers})


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Columns as doubles; what is no number becomes null."""
    here = set(df.schema.names)
    return add(df, {c: to_number(f"`{c}`") for c in cols if c in here})


def align_columns(df: DataFrame, expected: T.StructType, target: str | None = None, keep_extra: bool = False) -> DataFrame:
    """Exactly the expected columns without the target: absent ones become typed nulls."""
    here = set(df.schema.names)
    wanted = [f for f in expected.fields if f.name != target]
    cols = [
        f"`{f.name}`" if f.name in here else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in wanted
    ]
    names = {f.name for f in wanted}
    extra = [f"`{c}`" for c in df.schema.names if c not in names] if keep_extra else []
    return df.selectExpr(*cols, *extra)


def typed_rows(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Cast every expected column and list what could not be cast in `row_errors`
    (`array<struct<field, value, reason>>`). Whole-number fields take whole fractions (12.0) and
    reject others (12.5), whether they come as numbers or as text."""
    here = set(df.schema.names)
    fields = [f for f in expected.fields if f.name in here and not isinstance(f.dataType, T.StringType)]
    if not fields:
        return add(df, {"row_errors": "CAST(array() AS ARRAY<STRUCT<field: STRING, value: STRING, reason: STRING>>)"})
    checks, casts = [], {}
    for f in fields:
        kind = f.dataType.simpleString()
        text = f"CAST(`{f.name}` AS STRING)"
        cast = f"try_cast({text} AS {kind})"
        if isinstance(f.dataType, T.IntegralType) and not isinstance(df.schema[f.name].dataType, T.IntegralType):
            number = f"try_cast({text} AS DOUBLE)"
            cast = f"coalesce({cast}, CASE WHEN {number} = floor({number}) THEN try_cast(try_cast({text} AS DECIMAL(38, 9)) AS {kind}) END)"
        checks.append(
            f"CASE WHEN `{f.name}` IS NOT NULL AND {cast} IS NULL THEN struct({lit(f.name)} AS field,"
            f" CAST(`{f.name}` AS STRING) AS value, {lit('not a ' + kind)} AS reason) END"
        )
        casts[f.name] = cast
    marked = add(df, {"row_errors": f"array_compact(array({', '.join(checks)}))"})
    return add(marked, casts)


def validate_rows(df: DataFrame, expected: T.StructType, mode: str = "quarantine"):
    """Split typed rows into `(good, bad)`; in `reject` mode any bad row raises."""
    typed = typed_rows(df, expected)
    bad = typed.where("size(row_errors) > 0")
    if mode == "reject":
        examples = bad.select("row_errors").limit(10).collect()
        if examples:
            raise ValidationError(f"rows with wrong types: {[e.row_errors for e in examples]}")
        return typed.drop("row_errors"), bad
    return typed.where("size(row_errors) = 0").drop("row_errors"), bad


def error_rows(bad: DataFrame, id_col: str) -> DataFrame:
    """One row per faulty field."""
    return bad.selectExpr(id_col, "inline(row_errors)")


def ensure_ids(
    df: DataFrame, id_col: str = "TransactionID", order: list[str] | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Keep given ids; number rows 1..n when there are none at all. Partly missing ids are an
    error, since such rows could not be matched to their scores."""
    if id_col in df.schema.names:
        seen = df.agg(F.count(id_col).alias("ids"), F.count(F.lit(1)).alias("rows")).first()
        if seen["ids"] == seen["rows"]:
            return df
        if seen["ids"]:
            raise ValidationError(f"{seen['rows'] - seen['ids']} rows have no {id_col}")
        df = df.drop(id_col)
    order = order or df.schema.names
    return dense_position(df, order, name=id_col, policy=policy)


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise EmptyBatchError("the batch has no rows")
    return df


def require_model(model):
    if model is None:
        raise MissingModelError("no model is loaded")
    return model


def columns_by_kind(df: DataFrame, exclude=()) -> dict[str, list[str]]:
    """`text`, `number` (without V columns) and `v` columns."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    number = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return {
        "text": [f.name for f in fields if isinstance(f.dataType, T.StringType)],
        "number": [c for c in number if not c.startswith("V")],
        "v": [c for c in number if c.startswith("V")],
    }


def split_target(df: DataFrame, target: str = "isFraud") -> tuple[DataFrame, DataFrame]:
    return df.drop(target), df.select(target)


_INTEGERS = (("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -2147483648, 2147483647))
_FLOAT_LIMIT = 3.4028234663852886e38


def value_ranges(df: DataFrame) -> DataFrame:
    """Smallest and largest value of every numeric column as rows `(column, low, high)`, from
    one pass."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    one = df.agg(
        *[F.min(c).cast("double").alias(f"__lo{i}") for i, c in enumerate(cols)],
        *[F.max(c).cast("double").alias(f"__hi{i}") for i, c in enumerate(cols)],
    )
    parts = ", ".join(
        f"struct({lit(c)} AS column, __lo{i} AS low, __hi{i} AS high)" for i, c in enumerate(cols)
    )
    return one.selectExpr(f"explode(array({parts})) AS r").select("r.*")


def narrow_types(df: DataFrame) -> DataFrame:
    """Store numbers in the smallest type strictly holding their range; wide integers stay."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    casts = {}
    for r in value_ranges(df).collect():  # one row per column
        if r["low"] is None:
            continue
        if isinstance(kinds[r["column"]], T.IntegralType):
            fits = [t for t, lo, hi in _INTEGERS if lo < r["low"] and r["high"] < hi]
            if fits:
                casts[r["column"]] = f"CAST(`{r['column']}` AS {fits[0]})"
        elif isinstance(kinds[r["column"]], T.DoubleType) and max(-r["low"], r["high"]) < _FLOAT_LIMIT:
            casts[r["column"]] = f"CAST(`{r['column']}` AS float)"
    return df.selectExpr(*[f"{casts[c]} AS `{c}`" if c in casts else f"`{c}`" for c in df.schema.names])
