"""Grouped statistics fitted once and joined back to rows.

Grouping combines map-side, so a key with a third of all rows costs one row per task in the
shuffle. The fitted tables are joined back as lookups; a window over the key would put such a
key into a single task instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import number_text
from ..functions.scalars import ratio
from ..functions.sqltext import add, lit
from ..session import materialise, read_once
from .joins import unique_ids
from .skew import DEFAULT_POLICY, SkewPolicy, hashed, is_small, lookup, skewed_lookup

_EVERYTHING = "*"
_INLINE = 64  # columns with at most this many values become a constant in the plan


@dataclass(frozen=True)
class Profiles:
    """Statistics per `(name, value)` of many key columns.

    `table` has `name, value, n` and, when an amount was given, `amt_mean, amt_std, aux_mean`.
    `sizes` counts the values per column, `total` the rows fitted on. `inline` holds the rows
    of columns with few values, which need no join at all.
    """

    table: DataFrame
    sizes: dict
    total: int
    inline: dict

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> "Profiles":
        return _measured(spark.read.parquet(path))


def _measured(table: DataFrame) -> Profiles:
    everything = F.col("name") == _EVERYTHING
    sizes = {
        r["name"]: r
        for r in table.groupBy("name").agg(
            F.count(F.lit(1)).alias("values"), F.max(F.when(everything, F.col("n"))).alias("rows")
        ).collect()  # one row per key column
    }
    total = sizes[_EVERYTHING]["rows"] if _EVERYTHING in sizes else 0
    sizes = {k: r["values"] for k, r in sizes.items() if k != _EVERYTHING}
    inline: dict = {k: {} for k, n in sizes.items() if n <= _INLINE}
    if inline:
        for r in table.where(F.col("name").isin(list(inline))).collect():  # at most 64 rows per column
            inline[r["name"]][r["value"]] = r.asDict()
    return Profiles(table, sizes, total, inline)


def _constant(rows: dict, stats: list[str], key: str) -> str:
    """SQL text of a struct with the statistics of `key`, looked up among the few known values."""

    def number(r: dict, stat: str) -> str:
        kind = "BIGINT" if stat == "n" else "DOUBLE"
        if r[stat] is None:
            return f"CAST(NULL AS {kind})"
        return f"{r[stat]}L" if stat == "n" else lit(float(r[stat]))

    pairs = ", ".join(
        f"{lit(v)}, named_struct({', '.join(f'{lit(s)}, {number(r, s)}' for s in stats)})" for v, r in rows.items()
    )
    return f"try_element_at(map({pairs}), {key})"


def profile_table(df: DataFrame, cols: list[str], amount: str | None = None, aux: str | None = None) -> DataFrame:
    """`(name, value, n, ...)` for every column in one scan and one shuffle. Nulls are no value."""
    pairs = [f"struct({lit(_EVERYTHING)} AS name, '' AS value)"]
    pairs += [
        f"struct({lit(c)} AS name, {number_text(f'`{c}`', df.schema[c].dataType)} AS value)" for c in cols
    ]
    carried = [c for c in dict.fromkeys([amount, aux]) if c]
    long = df.selectExpr(*carried, f"explode(array({', '.join(pairs)})) AS pair").selectExpr(*carried, "pair.*")
    aggs = [F.count(F.lit(1)).alias("n")]
    if amount:
        aggs += [F.avg(amount).alias("amt_mean"), F.stddev_samp(amount).alias("amt_std")]
        aggs += [(F.avg(aux) if aux else F.lit(None).cast("double")).alias("aux_mean")]
    return long.where(F.col("value").isNotNull()).groupBy("name", "value").agg(*aggs)


def fit_profiles(df: DataFrame, cols, amount: str | None = None, aux: str | None = None) -> Profiles:
    """Fit the statistics of all key columns present in `df`."""
    here = set(df.schema.names)
    present = [c for c in dict.fromkeys(cols) if c in here]
    return _measured(materialise(profile_table(df, present, amount, aux)))


def attach_profiles(
    df: DataFrame, profiles: Profiles, wanted: dict[str, dict[str, str]], policy: SkewPolicy = DEFAULT_POLICY,
    spread: str = "TransactionID", ready=(),
) -> DataFrame:
    """Left-join fitted statistics: `wanted[column]` maps new column to statistic. One join per
    key column, whatever the number of statistics. Null and unseen keys get null. The statistics of `ready` key columns are in `df` already.

    Key columns beyond the broadcast limit are looked up together in one long exchange of (id, column, value), where ids are known to be
    unique: the rows are exchanged once, not once per column.
    """
    outputs = {o for per in wanted.values() for o in per}
    few = [c for c in wanted if profiles.inline.get(c)]
    spelled = [c for c in wanted if c not in few]
    joined = [c for c in spelled if c not in ready]
    base = [c for c in df.schema.names if c not in outputs]
    values = {c: number_text(f"`{c}`", df.schema[c].dataType) for c in wanted}
    fresh = {o for c, per in wanted.items() if c not in ready for o in per}
    keyed = add(df, {f"__v_{c}": values[c] for c in joined}, drop=fresh & set(df.schema.names))
    # Exchanges come first, while the rows are narrow.
    large = [c for c in large_keys(profiles, joined, policy) if spread in base]
    rest = [c for c in joined if c not in large]
    if len(large) > 1:
        keyed = read_once(keyed)
        if unique_ids(keyed, spread, policy):
            keyed, large = _attach_long(keyed, profiles, {c: wanted[c] for c in large}, policy, spread), []
    for c in [*large, *rest]:
        key, size = f"__v_{c}", profiles.sizes.get(c, 0)
        stats = [f"{stat} AS `{o}`" for o, stat in wanted[c].items()]
        table = profiles.table.where(F.col("name") == c)
        if c in rest:
            keyed = lookup(keyed, table.selectExpr(f"value AS `{key}`", *stats), key, policy, size)
        else:
            table = table.selectExpr(f"value AS `{key}`", "n AS __n", *stats)
            keyed = skewed_lookup(keyed, table, [key], "__n", profiles.total, spread, policy).drop("__n")
        keyed = keyed.drop(key)
    # Step by step, so that a key is spelled and looked up once however many statistics it has.
    keyed = add(keyed, {f"__v_{c}": values[c] for c in few})
    keyed = add(keyed, {
        f"__m_{c}": _constant(profiles.inline[c], sorted(set(wanted[c].values())), f"__v_{c}") for c in few
    })
    keyed = add(keyed, {o: f"__m_{c}.{stat}" for c in few for o, stat in wanted[c].items()})
    return keyed.select(*[F.col(f"`{c}`") for c in base], *[F.col(f"`{o}`") for c in [*few, *spelled] for o in wanted[c]])


def large_keys(profiles: Profiles, cols, policy: SkewPolicy = DEFAULT_POLICY) -> list[str]:
    """Key columns whose statistics are beyond the broadcast limit."""
    return [c for c in cols if not profiles.inline.get(c) and profiles.sizes.get(c, 0) * policy.row_bytes > policy.broadcast_bytes]


def _attach_long(
    keyed: DataFrame, profiles: Profiles, wanted: dict[str, dict[str, str]], policy: SkewPolicy, spread: str
) -> DataFrame:
    values = {c: f"`__v_{c}`" for c in wanted}
    folded = statistics_by_id(keyed, values, profiles, wanted, policy, spread)
    return keyed.drop(*[f"__v_{c}" for c in wanted]).join(hashed(folded, policy, keyed.count()), spread, "left")


def statistics_by_id(
    keyed: DataFrame, values: dict[str, str], profiles: Profiles, wanted: dict[str, dict[str, str]], policy: SkewPolicy, spread: str
) -> DataFrame:
    """The statistics of many large key columns, one row per id: ids and `values` (SQL text) travel to the table, frequent values looked up apart.
    Ids must be present and unique."""
    pairs = ", ".join(f"struct({lit(c)} AS name, {values[c]} AS value)" for c in wanted)
    long = keyed.selectExpr(f"`{spread}`", f"inline(filter(array({pairs}), p -> p.value IS NOT NULL))")
    stats = sorted({stat for per in wanted.values() for stat in per.values()})
    table = profiles.table.where(F.col("name").isin(list(wanted))).selectExpr(
        "name", "value", "n AS __n", *[f"{stat} AS `__s_{stat}`" for stat in stats]
    )
    found = skewed_lookup(long, table, ["name", "value"], "__n", profiles.total * len(wanted), spread, policy)
    return found.groupBy(spread).agg(*[
        F.max(F.when(F.col("name") == c, F.col(f"__s_{stat}"))).alias(o) for c, per in wanted.items() for o, stat in per.items()
    ])


def profile_features(
    df: DataFrame,
    profiles: Profiles,
    amount: str,
    aux: str = "D1",
    counts: dict[str, str] | None = None,
    frequency=(),
    normalised=(),
    amounts=(),
    uids=(),
    policy: SkewPolicy = DEFAULT_POLICY,
    ready=(),
) -> DataFrame:
    """Frequency, amount and per-user features from fitted statistics.

    `counts` maps key columns to plain count columns; `frequency` and `normalised` columns get
    `{c}_freq` (and `{c}_freq_norm`); `amounts` columns get mean, sample deviation and distance
    from the mean of the amount; `uids` get their count, amount statistics, two relative
    amounts and the mean of `aux`. The statistics of `ready` key columns are in `df` already.
    """
    wanted = wanted_statistics(df.schema.names, amount, aux, counts, frequency, normalised, amounts, uids)
    df = attach_profiles(df, profiles, wanted, policy, ready=ready)
    derived: dict[str, str] = {}
    for c in normalised:
        if c in wanted:
            derived[f"{c}_freq_norm"] = f"try_divide({c}_freq, {float(profiles.total)}D)"
    for c in amounts:
        if c in wanted:
            derived[f"{c}_{amount}_dev"] = f"{amount} - {c}_{amount}_mean"
    for u in uids:
        if u in wanted:
            mean, std = f"{u}_{amount}_mean", f"{u}_{amount}_std"
            derived[f"{u}_{amount}_to_mean"] = ratio(amount, mean, 0.001)
            derived[f"{u}_{amount}_to_std"] = ratio(f"({amount} - {mean})", std, 0.001)
    return add(df, derived)


def wanted_statistics(here, amount: str, aux: str = "D1", counts: dict[str, str] | None = None, frequency=(), normalised=(), amounts=(), uids=()) -> dict:
    """What `profile_features` attaches: new column to statistic for each key column among `here`."""
    wanted: dict[str, dict[str, str]] = {}

    def want(col: str, **out: str) -> None:
        if col in here:
            wanted.setdefault(col, {}).update({name: stat for stat, name in out.items()})

    for c, name in (counts or {}).items():
        want(c, n=name)
    for c in dict.fromkeys([*frequency, *normalised]):
        want(c, n=f"{c}_freq")
    for c in dict.fromkeys([*amounts, *uids]):
        want(c, amt_mean=f"{c}_{amount}_mean", amt_std=f"{c}_{amount}_std")
    for u in uids:
        want(u, n=f"{u}_count", aux_mean=f"{u}_{aux}_mean")
    return wanted


def group_lookup(
    df: DataFrame, keys: list[str], aggs: dict[str, Column], policy: SkewPolicy = DEFAULT_POLICY,
    spread: str = "TransactionID",
) -> DataFrame:
    """Aggregate by `keys` and give every row its group's values. Rows with a null key get
    null: a missing key is no group."""
    df = df.drop(*aggs)
    grouped = df.dropna(subset=keys).groupBy(*keys)
    columns = [c.alias(n) for n, c in aggs.items()]
    table = materialise(grouped.agg(*columns, F.count(F.lit(1)).alias("__n")))
    return counted_lookup(df, table, keys, "__n", policy, spread).drop("__n")


def counted_lookup(
    df: DataFrame, table: DataFrame, keys: list[str], weight: str, policy: SkewPolicy = DEFAULT_POLICY, spread: str = "TransactionID"
) -> DataFrame:
    """Left join with a stored table of groups whose `weight` counts the rows of each. Its keys are counted: up to the broadcast limit it is
    broadcast, beyond it frequent keys are looked up apart (`skewed_lookup`)."""
    size = table.agg(F.count(F.lit(1)).alias("keys"), F.sum(weight).alias("rows")).first()
    if size["keys"] * policy.row_bytes <= policy.broadcast_bytes or spread not in df.schema.names:
        return lookup(df, table, keys, policy, size["keys"])
    return skewed_lookup(df, table, keys, weight, size["rows"], spread, policy)


def zscore_by(df: DataFrame, key: str, amount: str, name: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """`(amount - mean) / (std + 1)` within `key`."""
    joined = group_lookup(
        df, [key], {"__m": F.avg(amount), "__s": F.stddev_samp(amount)}, policy
    )
    return add(joined, {name: ratio(f"({amount} - __m)", "__s", 1.0)}, drop=("__m", "__s"))


@dataclass(frozen=True)
class TargetRates:
    """Out-of-fold and full rates of a target per key, and the overall rate."""

    col: str
    fold_table: DataFrame
    full_table: DataFrame
    overall: float
    rows: int
    total: int


def hash_fold(id_col: str, folds: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(folds))


def fit_target_rates(df: DataFrame, col: str, target: str, fold: Column) -> TargetRates:
    """Per key: the target mean over all other folds, `(S - s) / (C - c)`, and over all rows."""
    cells = materialise(
        df.groupBy(F.col(col), fold.alias("__fold")).agg(F.sum(target).alias("__s"), F.count(target).alias("__c"), F.count(F.lit(1)).alias("__n"))
    )
    overall = cells.agg(F.try_divide(F.sum("__s"), F.sum("__c"))).first()[0]
    known = cells.where(F.col(col).isNotNull())
    per_key = Window.partitionBy(col)  # at most one row per fold
    all_s, all_c = F.sum("__s").over(per_key), F.sum("__c").over(per_key)
    fold_table = known.select(
        col, "__fold", "__n", F.try_divide(all_s - F.col("__s"), all_c - F.col("__c")).alias("__rate")
    )
    full = known.groupBy(col).agg(F.try_divide(F.sum("__s"), F.sum("__c")).alias("__rate"), F.sum("__n").alias("__n"))
    size = cells.agg(F.count(F.lit(1)), F.coalesce(F.sum("__n"), F.lit(0))).first()
    return TargetRates(col, fold_table, full, overall, size[0], size[1])


def target_rate_feature(
    df: DataFrame, rates: TargetRates, name: str, fold: Column | None = None,
    policy: SkewPolicy = DEFAULT_POLICY, spread: str = "TransactionID",
) -> DataFrame:
    """Training rows (`fold` given) get the rate of the other folds, new rows the full rate;
    keys without one get the overall rate."""
    if fold is not None:
        keyed, table, on = df.withColumn("__fold", fold), rates.fold_table, [rates.col, "__fold"]
    else:
        keyed, table, on = df, rates.full_table, [rates.col]
    if rates.rows * policy.row_bytes <= policy.broadcast_bytes or spread not in keyed.schema.names:
        joined = lookup(keyed, table.drop("__n"), on, policy, rates.rows)
    else:  # one domain may hold a large share of all rows
        joined = skewed_lookup(keyed, table, on, "__n", rates.total, spread, policy).drop("__n")
    return joined.withColumn(name, F.coalesce("__rate", F.lit(rates.overall))).drop("__rate", "__fold")


def distinct_counts(df: DataFrame, cols, approximate: bool = False) -> DataFrame:
    """One row with the number of distinct values of each column."""
    count = (lambda c: F.approx_count_distinct(c)) if approximate else (lambda c: F.count_distinct(c))
    return df.agg(*[count(F.col(c)).alias(f"{c}_unique") for c in cols])
