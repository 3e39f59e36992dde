"""Mergeable sketches: distinct values per day, quantiles per minute. Stored once, united into any span without reading the rows again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import number_text
from ..functions.sqltext import lit

DISTINCT_BITS = 14   # 2^14 registers: a standard error of 1.04 / 2^7 for united sketches
QUANTILE_K = 800     # rank errors of about half a per cent
RANK_ERROR = 0.01


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Relative standard error of a united sketch."""
    return 1.04 / 2 ** (bits / 2)


def distinct_sketches(df: DataFrame, cols, slot: str, bits: int = DISTINCT_BITS) -> DataFrame:
    """`(slot, name, rows, sketch)`: one HyperLogLog sketch for each value of `slot` (a day, say) and column.

    Values count by their text, nulls do not count, and a missing slot is a slot. One pass and one shuffle of sketches: a slot with a third of all rows is combined
    in the tasks that read it.
    """
    pairs = ", ".join(f"struct({lit(c)} AS name, {number_text(f'`{c}`', df.schema[c].dataType)} AS value)" for c in cols)
    long = df.selectExpr(f"`{slot}` AS slot", f"inline(array({pairs}))")
    return long.groupBy("slot", "name").agg(F.count("value").alias("rows"), F.hll_sketch_agg("value", F.lit(bits)).alias("sketch"))


def united_distinct(sketches: DataFrame, by=()) -> DataFrame:
    """Estimated distinct values of each column over all given slots, or for each group of them."""
    keys = ["name", *by]
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))


def quantile_sketches(df: DataFrame, value: str, sec: str, width: int = 60, k: int = QUANTILE_K) -> DataFrame:
    """`(slot, rows, sketch)`: one quantile sketch for every `width` seconds, `slot` being their first. Nulls do not count."""
    known = df.where(F.col(value).isNotNull() & F.col(sec).isNotNull()).select(F.expr(f"floor(`{sec}` / {width}) * {width}").alias("slot"), F.col(value).cast("double").alias("v"))
    return known.groupBy("slot").agg(F.count("v").alias("rows"), F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))


def window_quantiles(sketches: DataFrame, q: float, width: int, slide: int | None = None) -> DataFrame:
    """`(window_start, rows, quantile)` for windows of `width` seconds every `slide` seconds, merged from the slots inside them."""
    slide = slide or width
    first = f"floor(slot / {slide}) * {slide}"
    starts = f"filter(sequence({first} - {(width - 1) // slide * slide}, {first}, {slide}), s -> s + {width} > slot)"
    spread = sketches.selectExpr(f"explode({starts}) AS window_start", "rows", "sketch")
    merged = spread.groupBy("window_start").agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select("window_start", "rows", F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("quantile"))
