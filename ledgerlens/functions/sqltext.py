"""Small helpers for expressions written as SQL text.

Text costs one call into the JVM per column, however large the expression, so plans of a few
hundred columns are quick to build.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame


def lit(value) -> str:
    """A SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float):
        if math.isfinite(value):
            return f"{value!r}D"
        return f"CAST('{'NaN' if math.isnan(value) else 'Infinity' if value > 0 else '-Infinity'}' AS DOUBLE)"
    if isinstance(value, int):
        return str(value)
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def lits(values) -> str:
    return ", ".join(lit(v) for v in values)


def map_of(mapping: dict) -> str:
    return "map(" + ", ".join(f"{lit(k)}, {lit(v)}" for k, v in mapping.items()) + ")"


def add(df: DataFrame, columns: dict[str, str], drop=()) -> DataFrame:
    """`df` with columns added or replaced (and others dropped), all computed from `df` itself."""
    if not columns and not drop:
        return df
    gone = [c for c in df.schema.names if c in columns or c in drop]
    star = f"* EXCEPT ({', '.join(f'`{c}`' for c in gone)})" if gone else "*"
    return df.selectExpr(star, *[f"{sql} AS `{name}`" for name, sql in columns.items()])
