"""Composite string keys and the text form of numeric columns, as SQL expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .sqltext import lit


def number_text(name: str, dtype: T.DataType) -> str:
    """Text of a column as it appears inside keys: whole doubles keep their `.0`.

    Spark switches to `1.0E7` at ten million; whole values go through a decimal instead,
    so keys stay readable and stable.
    """
    if isinstance(dtype, T.FloatType):
        name = f"CAST({name} AS DOUBLE)"
    elif not isinstance(dtype, T.DoubleType):
        return name if isinstance(dtype, T.StringType) else f"CAST({name} AS STRING)"
    return (
        f"CASE WHEN abs({name}) >= 1e7D AND abs({name}) < 1e18D AND {name} % 1 = 0 "
        f"THEN concat(CAST(CAST({name} AS DECIMAL(20,0)) AS STRING), '.0') ELSE CAST({name} AS STRING) END"
    )


def text_of(df: DataFrame, name: str, null_token: str) -> str:
    """`name` as text with `null_token` standing for missing."""
    return f"coalesce({number_text(name, df.schema[name].dataType)}, {lit(null_token)})"


def composite_key(df: DataFrame, names, sep: str = "_", null_token: str = "nan") -> str:
    """Join several columns into one key."""
    return f"concat_ws({lit(sep)}, {', '.join(text_of(df, n, null_token) for n in names)})"


def card_id(df: DataFrame, card_cols) -> str:
    """All card columns joined with `_`; missing parts are `nan`. Build it before the card
    columns are rewritten to text, where missing becomes `-1`."""
    here = set(df.schema.names)
    return composite_key(df, [c for c in card_cols if c in here])


def card_text(df: DataFrame, name: str) -> str:
    """A card column rewritten as text; missing is `-1.0` for doubles and `-1` otherwise."""
    is_double = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return text_of(df, name, "-1.0" if is_double else "-1")
