"""Ordered features per key, dense numbering and running totals without a single hot task.

Spark runs a window partition in one task. When a key is too large for that, its rows are
numbered with a range shuffle (which splits inside a key), cut into blocks of equal size, and
each block receives copies of the few rows before it. The window then runs per block.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sqltext import add
from ..session import materialise
from .skew import DEFAULT_POLICY, SkewPolicy, broadcast_if_small, hot_keys, is_small

_SHIFT = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def range_slices(df: DataFrame, order: list, rows: int, policy: SkewPolicy) -> DataFrame:
    """Rows in global order with `__slice` and `__idx` (position in the slice), written out so
    that the slice borders stay fixed when tasks are rerun."""
    n = max(1, math.ceil(rows / policy.slice_rows))
    placed = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("__mid", F.monotonically_increasing_id())
        .withColumn("__slice", F.shiftright("__mid", _SHIFT))
        .withColumn("__idx", F.col("__mid").bitwiseAND(F.lit((1 << _SHIFT) - 1)))
        .drop("__mid")
    )
    return materialise(placed)


def dense_position(
    df: DataFrame,
    order: list,
    key: list[str] | None = None,
    name: str = "position",
    rows: int | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Number rows 1..n in `order`, over everything or within `key`.

    Large inputs use one range shuffle plus a table with one row per slice and key.
    """
    key = key or []
    if rows is None and is_small(df, policy):
        scope = Window.partitionBy(*key) if key else Window.partitionBy()
        return df.withColumn(name, F.row_number().over(scope.orderBy(*order)).cast("bigint"))
    rows = df.count() if rows is None else rows
    sliced = range_slices(df, [*key, *order], rows, policy)
    sizes = sliced.groupBy(*key, "__slice").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__idx").alias("__first")
    )
    # A global numbering has one row per slice here; with a key, one per slice and key.
    scope = Window.partitionBy(*key) if key else Window.partitionBy()
    before = scope.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(
        sizes.select(
            *[F.col(k).alias(f"__k_{k}") for k in key],
            F.col("__slice").alias("__k_slice"),
            "__first",
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        )
    )
    match = sliced["__slice"] == F.col("__k_slice")
    for k in key:
        match = match & sliced[k].eqNullSafe(F.col(f"__k_{k}"))
    known = starts.count()
    return (
        sliced.join(broadcast_if_small(starts, policy, known), match)
        .withColumn(name, F.col("__idx") - F.col("__first") + F.col("__before") + 1)
        .drop("__slice", "__idx", "__first", "__before", "__k_slice", *[f"__k_{k}" for k in key])
    )


def running_totals(
    df: DataFrame,
    order: list[str],
    sums: dict[str, str],
    group: list[str] | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Inclusive running sums of columns: `sums` maps output name to input column.

    Callers reduce to one row per distinct order value first, so ties cannot occur. Rows without a
    group are one group, whatever the size of the input.
    """
    group = group or []
    if is_small(df, policy):
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(w).alias(n) for n, c in sums.items()])
    df = materialise(df)
    sliced = range_slices(df, [*group, *order], df.count(), policy)
    part = sliced.groupBy(*group, "__slice").agg(*[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
    before = (
        Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = materialise(
        part.select(
            *[F.col(g).alias(f"__k_{g}") for g in group], F.col("__slice").alias("__k_slice"),
            *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__c_{n}") for n in sums],
        )
    )
    inner = (
        Window.partitionBy(*group, "__slice").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    match = sliced["__slice"] == F.col("__k_slice")
    for g in group:
        match = match & sliced[g].eqNullSafe(F.col(f"__k_{g}"))
    return (
        sliced.join(broadcast_if_small(carried, policy, carried.count()), match)
        .select(*df.columns, *[(F.sum(c).over(inner) + F.col(f"__c_{n}")).alias(n) for n, c in sums.items()])
    )


def _over(keys, order) -> str:
    return f"PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}"


def _staged(df, lagged, w) -> DataFrame:
    for stage in lagged:
        df = add(df, {n: sql.format(w=w) for n, sql in stage.items()})
    return df


_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _windowed(df, keys, order, lagged, filled, index) -> DataFrame:
    w = _over(keys, order)
    out = _staged(df, lagged, w)
    late = {n: f"last({sql}, true) OVER ({w} {_SO_FAR})" for n, sql in filled.items()}
    if index:
        late[index] = f"CAST(row_number() OVER ({w}) - 1 AS BIGINT)"
    return add(out, late)


def _blocked(df, key, order, lagged, filled, index, history, rows, policy) -> DataFrame:
    size = max(policy.block_rows, history + 1)
    # Every block is followed by copies of its last rows at the head of the next block.
    spread = add(
        dense_position(df, order, [key], "__pos", rows, policy),
        {"__halo": f"explode(CASE WHEN pmod(__pos - 1, {size}) >= {size - history} THEN array(0, 1) ELSE array(0) END)"},
    )
    spread = add(spread, {"__block": f"(__pos - 1) DIV {size} + __halo"})
    w = _over([key, "__block"], ["__pos"])
    out = _staged(spread, lagged, w).where("__halo = 0")
    if filled:
        out = add(out, {f"__in_{n}": f"last({sql}, true) OVER ({w} {_SO_FAR})" for n, sql in filled.items()})
        # Last known value of each block, then of all blocks before it: one row per block.
        ends = out.groupBy(key, "__block").agg(
            *[F.expr(f"max_by({sql}, CASE WHEN {sql} IS NOT NULL THEN __pos END)").alias(f"__end_{n}") for n, sql in filled.items()]
        )
        earlier = f"PARTITION BY {key} ORDER BY __block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        carry = materialise(
            ends.selectExpr(
                key, "__block", *[f"last(__end_{n}, true) OVER ({earlier}) AS __carry_{n}" for n in filled]
            )
        )
        carry = carry.withColumnsRenamed({key: "__k", "__block": "__b"})
        same = out[key].eqNullSafe(F.col("__k")) & (out["__block"] == F.col("__b"))
        out = out.join(broadcast_if_small(carry, policy, carry.count()), same, "left").drop("__k", "__b")
        out = add(out, {n: f"coalesce(__in_{n}, __carry_{n})" for n in filled})
    if index:
        out = add(out, {index: "__pos - 1"})
    fresh = [*(n for stage in lagged for n in stage), *filled, *([index] if index else [])]
    return out.select(*[c for c in df.schema.names if c not in fresh], *fresh)


def ordered_features(
    df: DataFrame,
    key: str,
    order: list[str],
    lagged: dict[str, str] | list[dict[str, str]] | None = None,
    filled: dict[str, str] | None = None,
    index: str | None = None,
    history: int = 1,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Features that need the rows of a key in order.

    `lagged` expressions are SQL text with `{w}` where the window goes and may look back
    `history` rows at most; given as a list, later stages may read earlier ones. `filled` columns take the last known value so far (they may read
    `lagged` outputs); `index` numbers rows from 0. Rows without a key are a group like any other, and are split like one when they are many.
    """
    lagged = [lagged] if isinstance(lagged, dict) else lagged or []
    filled = filled or {}
    hot = None if is_small(df, policy) else hot_keys(df, key, policy)
    if hot is None:
        return _windowed(df, [key], order, lagged, filled, index)
    table, n, rows = hot
    table = broadcast_if_small(table.select(F.col(key).alias("__hot")), policy, n)
    is_hot = df[key].eqNullSafe(F.col("__hot"))
    cold = _windowed(df.join(table, is_hot, "left_anti"), [key], order, lagged, filled, index)
    heavy = _blocked(df.join(table, is_hot, "left_semi"), key, order, lagged, filled, index, history, rows, policy)
    return cold.unionByName(heavy)


def recent_count(
    df: DataFrame,
    key: str,
    time: str,
    seconds: int,
    name: str,
    policy: SkewPolicy = DEFAULT_POLICY,
    source: DataFrame | None = None,
) -> DataFrame:
    """Rows of the key in `(t - seconds, t]`; null where the key or the time is missing.

    The count depends on key and second only, so rows are first reduced to one per key and
    second, from `source` if `df` was derived from it at some cost. Large inputs with hot keys cut that table into days that each carry the tail of the day
    before, which bounds a task by the seconds of one day however hot the key is. Without hot keys the rows stay where the other windows of the key put them.
    """
    frame = f"RANGE BETWEEN {seconds - 1} PRECEDING AND CURRENT ROW"
    rows = df if source is None else source
    if is_small(df, policy) or hot_keys(rows, key, policy) is None:
        counted = f"count(1) OVER (PARTITION BY {key} ORDER BY {time} {frame})"
        out = add(df, {name: f"CASE WHEN {key} IS NOT NULL AND {time} IS NOT NULL THEN {counted} END"})
        return out if is_small(df, policy) else out.select(key, time, *[c for c in out.columns if c not in (key, time)])  # as the join has them
    day = max(86400, seconds)
    counts = (
        rows.dropna(subset=[key, time]).groupBy(key, time).agg(F.count(F.lit(1)).alias("__n"))
        .selectExpr("*", f"explode(CASE WHEN pmod({time}, {day}) > {day - seconds} THEN array(0, 1) ELSE array(0) END) AS __halo")
        .selectExpr("*", f"floor({time} / {day}) + __halo AS __day")
        .selectExpr(key, time, "__halo", f"sum(__n) OVER (PARTITION BY {key}, __day ORDER BY {time} {frame}) AS {name}")
        .where("__halo = 0").drop("__halo")
    )
    return df.join(counts, [key, time], "left")
