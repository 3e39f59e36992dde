"""Named schemas: saved as JSON files in one folder, compared with what arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .files import read_text, write_text


class SchemaNotFoundError(KeyError):
    """The catalogue holds no schema of this name."""


class SchemaMismatchError(ValueError):
    """The frame does not have the expected columns."""

    def __init__(self, result: dict):
        super().__init__(f"schema mismatch: {result}")
        self.result = result


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.schema.json"


def save_schema(spark: SparkSession, schema: T.StructType, root: str, name: str) -> str:
    """Add or replace one named schema."""
    write_text(spark, _path(root, name), schema.json())
    return _path(root, name)


def load_schema(spark: SparkSession, root: str, name: str) -> T.StructType:
    text = read_text(spark, _path(root, name))
    if text is None:
        raise SchemaNotFoundError(name)
    import json

    return T.StructType.fromJson(json.loads(text))


def type_family(dtype: T.DataType) -> str:
    """Types of one family may stand for each other."""
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if isinstance(dtype, T.FractionalType):
        return "fraction"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    return dtype.simpleString()


def compare_schema(actual: T.StructType, expected: T.StructType, strict: bool = False) -> dict:
    """`match`, `missing_columns`, `extra_columns` and `dtype_mismatches`; strict raises."""
    got = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in expected.fields}
    wrong = {
        c: {"expected": want[c].simpleString(), "actual": got[c].simpleString()}
        for c in want if c in got and type_family(want[c]) != type_family(got[c])
    }
    result = {
        "missing_columns": [c for c in want if c not in got],
        "extra_columns": [c for c in got if c not in want],
        "dtype_mismatches": wrong,
    }
    result = {"match": not any(result.values()), **result}
    if strict and not result["match"]:
        raise SchemaMismatchError(result)
    return result


def check_frame(df: DataFrame, root: str, name: str, strict: bool = False) -> dict:
    """Compare a frame with a named schema."""
    return compare_schema(df.schema, load_schema(df.sparkSession, root, name), strict)


def schema_rows(schema: T.StructType) -> list[tuple[int, str, str]]:
    return [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]


def schema_status(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per column of either side: status and the non-null rows actually present."""
    result = compare_schema(df.schema, expected)
    status = {f.name: "ok" for f in expected.fields}
    status.update({c: "missing" for c in result["missing_columns"]})
    status.update({c: "extra" for c in result["extra_columns"]})
    status.update({c: "mismatch" for c in result["dtype_mismatches"]})
    here = set(df.schema.names)
    parts = ", ".join(
        f"struct('{c}' AS column, '{s}' AS status, {f'count(`{c}`)' if c in here else '0L'} AS known)"
        for c, s in status.items()
    )
    return df.selectExpr(f"array({parts}) AS p").selectExpr("explode(p) AS p").select("p.*")
