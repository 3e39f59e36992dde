"""The feature sets: each takes a DataFrame and returns it with new columns.

All of them work on whatever subset of the raw columns is present.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, FeatureConfig
from ..functions import keys as K
from ..functions import rowwise as R
from ..functions import scalars as S
from ..functions import text as X
from ..functions.sqltext import add
from ..operators import stats as A
from ..operators.joins import on_projection, unique_ids
from ..operators.ordered import ordered_features, recent_count
from ..operators.skew import DEFAULT_POLICY, SkewPolicy, hashed, input_bytes, spread_small
from ..session import materialise, read_once


def _order(cfg: FeatureConfig) -> list[str]:
    return [cfg.time_col, cfg.id_col]


def with_card_id(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    return df if "card_id" in df.schema.names else add(df, {"card_id": K.card_id(df, cfg.card_cols)})


# ---- ordered building blocks ---------------------------------------------------------------

def _amount_past(cfg: FeatureConfig) -> dict[str, str]:
    amt, n = cfg.amount_col, cfg.rolling_rows
    return {
        "prev_amount": f"coalesce(lag({amt}) OVER ({{w}}), {amt})",
        "rolling_median_amt":
            f"coalesce(percentile({amt}, 0.5D) OVER ({{w}} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), {amt})",
    }


def _gap(cfg: FeatureConfig) -> str:
    dt = cfg.time_col
    return f"coalesce({dt} - lag({dt}) OVER ({{w}}), {cfg.first_gap})"


def _amount_compared(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    jump = S.ratio(cfg.amount_col, "prev_amount", 1.0)
    return add(df, {
        "amount_jump_ratio": jump,
        "is_amount_spike": S.flag(f"{jump} > {cfg.spike_ratio}D"),
        "amt_vs_rolling": S.ratio(cfg.amount_col, "rolling_median_amt", 1.0),
    })


_FILL = {"ProductCD_filled": "ProductCD"}


def amount_history(df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Previous amount and rolling median of the five amounts before, per card. A card's first
    row has no past, so both fall back to its own amount."""
    policy = policy.settled(df)
    out = ordered_features(
        df, "card_id", _order(cfg), _amount_past(cfg), history=cfg.rolling_rows, policy=policy
    )
    return _amount_compared(out, cfg)


def time_history(df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Seconds since the card's previous transaction and its transactions in the last hour."""
    policy = policy.settled(df)
    out = ordered_features(df, "card_id", _order(cfg), {"Transaction_time_gap": _gap(cfg)}, policy=policy)
    return recent_count(out, "card_id", cfg.time_col, cfg.velocity_seconds, "Transaction_cnt_1hr", policy, df)


def with_history(df: DataFrame, history: DataFrame | None, build, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    """Run `build`, which looks backwards only, on the rows and on what their cards did before.

    `history` holds earlier rows (id, time, amount, product, card columns; others are ignored). Of the result only
    the given rows are kept; an id that stands in both counts once, as a given row.
    """
    if history is None:
        return build(df)
    here = set(df.schema.names)
    wanted = [cfg.id_col, cfg.time_col, cfg.amount_col, "ProductCD", "card_id", *cfg.card_cols]
    past = history.select(*[c for c in dict.fromkeys(wanted) if c in here and c in history.schema.names])
    past = past.join(df.select(cfg.id_col), cfg.id_col, "left_anti").withColumn("__past", F.lit(True))
    both = df.withColumn("__past", F.lit(False)).unionByName(past, allowMissingColumns=True)
    return build(both).where("NOT __past").drop("__past")


def product_filled(df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """`ProductCD_filled`: the card's last known product so far."""
    policy = policy.settled(df)
    return ordered_features(df, "card_id", _order(cfg), filled=_FILL, policy=policy)


def card_sequence(df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Everything that needs a card's rows in order, from one shuffle and one sort."""
    policy = policy.settled(df)
    past = {**_amount_past(cfg), "Transaction_time_gap": _gap(cfg)}
    filled = _FILL if "ProductCD" in df.schema.names else None
    out = ordered_features(df, "card_id", _order(cfg), past, filled, history=cfg.rolling_rows, policy=policy)
    out = recent_count(out, "card_id", cfg.time_col, cfg.velocity_seconds, "Transaction_cnt_1hr", policy, df)
    return _amount_compared(out, cfg)


def uid_velocity(
    df: DataFrame, uids=("uid1", "uid2"), cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Seconds since the user's previous transaction, a rapid-fire flag and a running index. Of a
    wide frame only the id, the time and the users are shuffled."""
    policy = policy.settled(df)

    def build(part: DataFrame) -> DataFrame:
        for u in uids:
            since = f"{u}_time_since_last"
            part = ordered_features(
                part, u, _order(cfg), {since: _gap(cfg)}, index=f"{u}_trans_in_session", policy=policy
            )
            part = add(part, {f"{u}_is_rapid": S.flag(f"{since} < {cfg.velocity_seconds}")})
        return part

    return on_projection(df, [*_order(cfg), *uids], build, cfg.id_col, policy)


# ---- feature sets --------------------------------------------------------------------------

def amount_scalars(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    amt = cfg.amount_col
    return add(df, {
        f"{amt}_log": S.log_amount(amt),
        f"{amt}_decimal": S.decimal_part(amt),
        f"{amt}_is_round": S.is_round(amt),
        f"{amt}_bins": S.amount_bin(amt, cfg.amount_edges),
        f"{amt}_cents": S.cents(amt),
        f"{amt}_is_micro": S.flag(f"{amt} < {cfg.micro_amount}D"),
    })


def transaction_amount_features(
    df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    policy = policy.settled(df)
    amt = cfg.amount_col
    df = amount_scalars(with_card_id(df, cfg), cfg)

    def build(part: DataFrame) -> DataFrame:
        part = amount_history(part, cfg, policy)
        part = A.group_lookup(part, ["card_id", amt], {"amt_repeat_count": F.count(F.lit(1))}, policy)
        if "user_id" in part.schema.names:
            part = A.zscore_by(part, "user_id", amt, "amount_zscore", policy)
        return part

    return on_projection(df, ["card_id", *_order(cfg), amt, "user_id"], build, cfg.id_col, policy)


def time_scalars(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    df = add(df, {
        "Transaction_hour": S.hour_of_day(cfg.time_col),
        "Transaction_sec_in_day": S.second_of_day(cfg.time_col),
    })
    hour = "Transaction_hour"
    return add(df, {
        "Transaction_time_of_day": S.time_of_day(hour, cfg.time_of_day_edges),
        "Transaction_is_night": S.is_night(hour),
        "Transaction_is_business_hour": S.is_business_hour(hour),
        "Transaction_hour_sin": S.hour_sine(hour),
        "Transaction_hour_cos": S.hour_cosine(hour),
    })


def time_features(df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    policy = policy.settled(df)
    df = time_scalars(with_card_id(df, cfg), cfg)
    return on_projection(
        df, ["card_id", *_order(cfg)], lambda part: time_history(part, cfg, policy), cfg.id_col, policy
    )


def card_texts(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    """The card columns rewritten as text."""
    here = set(df.schema.names)
    return add(df, {c: K.card_text(df, c) for c in cfg.card_cols if c in here})


def card_keys(df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Card columns as text plus card-address and card-product keys."""
    policy = policy.settled(df)
    df = with_card_id(df, cfg)
    if "ProductCD" in df.schema.names:
        df = on_projection(
            df, ["card_id", *_order(cfg), "ProductCD"],
            lambda part: product_filled(part, cfg, policy), cfg.id_col, policy,
        )
    return _card_columns(df, cfg)


def _card_columns(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    here = set(df.schema.names)
    df = card_texts(df, cfg)
    fresh: dict[str, str] = {}
    for out, card, addr in (
        ("card1_addrs1", "card1", "addr1"), ("card1_addrs2", "card1", "addr2"), ("card2_addrs1", "card2", "addr1")
    ):
        if {card, addr} <= here:
            fresh[out] = f"concat({card}, '-', {K.text_of(df, addr, '0.0')})"
    if "ProductCD_filled" not in here:
        return add(df, fresh)
    for card in ("card1", "card2"):
        if card in here:
            fresh[f"{card}_ProductCD"] = f"concat({card}, '_', coalesce(ProductCD_filled, 'nan'))"
    return add(df, fresh, drop=("ProductCD_filled",))


def card_features(df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    policy = policy.settled(df)
    df = card_keys(df, cfg, policy)

    def build(part: DataFrame) -> DataFrame:
        part = A.group_lookup(part, ["card_id"], {"card_id_count": F.count(F.lit(1))}, policy)
        if "addr1" in part.schema.names:
            part = A.group_lookup(part, ["addr1"], {"card_add_count": F.count(F.lit(1))}, policy)
        return part

    return on_projection(df, ["card_id", "addr1"], build, cfg.id_col, policy)


def email_scalars(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    payer, receiver = cfg.email_cols
    here = set(df.schema.names)
    df = add(df, {c: X.normalise_email(c) if c in here else "'missing'" for c in cfg.email_cols})
    df = host_columns(df, {"P": payer, "R": receiver}, cfg)
    df = add(df, {
        "P_email_vendor": X.email_vendor("P_host_name", cfg.email_vendors),
        "R_email_vendor": X.email_vendor("R_host_name", cfg.email_vendors),
        "P_email_tld": X.email_tld("P_host_suffix"),
        "R_email_tld": X.email_tld("R_host_suffix"),
        "email_domain_match": S.flag(f"{payer} = {receiver}"),
        "email_presence": X.email_presence(payer, receiver),
    }, drop=("P_host_name", "R_host_name", "P_host_suffix", "R_host_suffix"))
    return df


def host_columns(df: DataFrame, hosts: dict[str, str], cfg: FeatureConfig = DEFAULT) -> DataFrame:
    """`{k}_host_name` and `{k}_host_suffix` of normalised host columns."""
    df = add(df, {f"__labels_{k}": X.host_labels(c) for k, c in hosts.items()})
    df = add(df, {f"__tail_{k}": X.host_tail(f"__labels_{k}") for k in hosts})
    parts = {}
    for k, c in hosts.items():
        known = (c, f"__labels_{k}", f"__tail_{k}", cfg.two_part_suffixes)
        parts[f"{k}_host_name"] = X.email_name(*known)
        parts[f"{k}_host_suffix"] = X.email_suffix(*known)
    return add(df, parts, drop=[f"__{part}_{k}" for k in hosts for part in ("labels", "tail")])


def email_features(
    df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY,
    fold: Column | None = None, rates: A.TargetRates | None = None,
) -> DataFrame:
    """With a target in `df` the domain rate is out-of-fold; with fitted `rates` and no fold it
    is the fitted rate; with neither it is 0."""
    policy = policy.settled(df)
    df = email_scalars(df, cfg)
    payer, receiver = cfg.email_cols
    trains = rates is None and cfg.target_col in df.schema.names
    if trains:
        fold = A.hash_fold(cfg.id_col, cfg.folds) if fold is None else fold

    def build(part: DataFrame) -> DataFrame:
        for col, out in ((payer, "P_domain_count"), (receiver, "R_domain_count")):
            part = A.group_lookup(part, [col], {out: F.count(F.lit(1))}, policy)
        found = A.fit_target_rates(part, payer, cfg.target_col, fold) if trains else rates
        if found is None:
            return add(part, {"P_domain_fraud_rate": "0D"})
        return A.target_rate_feature(part, found, "P_domain_fraud_rate", fold, policy)

    return on_projection(df, [payer, receiver, cfg.target_col], build, cfg.id_col, policy)


def device_features(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    has = set(df.schema.names)
    kind = "DeviceType" if "DeviceType" in has else "CAST(NULL AS STRING)"
    fresh = {
        "DeviceType_is_mobile": S.flag(f"{kind} = 'mobile'"),
        "DeviceType_is_desktop": S.flag(f"{kind} = 'desktop'"),
    }
    if "DeviceInfo" in has:
        fresh["Device_brand"] = X.device_brand("DeviceInfo")
        fresh["DeviceInfo_length"] = X.text_length("DeviceInfo")
    if "id_31" in has:
        fresh["browser"] = X.browser_name("id_31")
        # The output names keep their historical spelling.
        for word in ("chrome", "firefox", "edge", "safari"):
            fresh[f"Broser_is_{word}"] = X.mentions("id_31", word)
    system = "id_30" if "id_30" in has else "CAST(NULL AS STRING)"
    fresh["os_name"] = X.before_space(system)
    fresh["os_version"] = X.after_space(system)
    for label in ("Windows", "Mac", "iOS", "Android"):
        fresh[f"OS_is_{label}"] = X.mentions(system, label.lower())
    if "id_33" in has:
        fresh["Screen_width"] = X.screen_side("id_33", 1)
        fresh["Screen_height"] = X.screen_side("id_33", 2)
    df = add(df, fresh)
    if "id_33" not in has:
        return df
    return add(df, {
        "Screen_area": "CAST(Screen_width AS BIGINT) * Screen_height",
        "Screen_aspect_ratio": X.screen_aspect("Screen_width", "Screen_height"),
    })


def address_features(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    has = set(df.schema.names)
    fresh: dict[str, str] = {}
    if {"addr1", "addr2"} <= has:
        fresh["addr1_addr2"] = K.composite_key(df, ["addr1", "addr2"])
        fresh["both_addr_missing"] = "CAST(addr1 IS NULL AND addr2 IS NULL AS INT)"
    if {"addr1", "ProductCD"} <= has:
        fresh["addr1_ProductCD"] = K.composite_key(df, ["addr1", "ProductCD"])
    for c in ("addr1", "addr2", "dist1", "dist2"):
        if c in has:
            fresh[f"{c}_missing"] = S.missing_flag(c)
    for c in ("dist1", "dist2"):
        if c in has:
            fresh[f"{c}_log"] = S.log_distance(c)
    return add(df, fresh)


def v_features(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    """Row statistics of each V block and of all V columns."""
    every = [c for c in df.schema.names if c.startswith("V") and c[1:].isdigit()]
    if not every:
        return df
    present = set(every)
    blocks = {b: [c for c in cols if c in present] for b, cols in cfg.v_blocks.items()}
    blocks = {b: cols for b, cols in blocks.items() if cols}
    names = {
        b: {"sum": f"{b}_sum", "mean": f"{b}_mean", "std": f"{b}_std", "nulls": f"{b}_nan_count"} for b in blocks
    }
    blocks["all"] = every
    names["all"] = {
        "sum": "V_sum_all", "mean": "V_mean_all", "std": "V_std_all",
        "nulls": "V_nan_count_all", "null_ratio": "V_nan_ratio",
    }
    return R.row_statistics(df, blocks, names)


def id_features(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    has = set(df.schema.names)
    numeric = [c for c in cfg.numeric_id_cols if c in has]
    if numeric:
        df = R.row_statistics(
            df, {"id": numeric},
            {"id": {"nulls": "id_num_nan_count", "mean": "id_num_mean", "std": "id_num_std"}},
        )
    fresh = {out: S.flag(f"{c} = '{word}'") for out, (c, word) in cfg.id_flags.items() if c in has}
    if "id_34" in has:
        fresh["id_34_match"] = X.status_number("id_34")
    return add(df, fresh)


def uid_features(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    """User keys. Expects card columns as text and normalised e-mail domains."""
    here = set(df.schema.names)
    return add(df, {
        "uid1": K.composite_key(df, ["card1", "addr1"]),
        "uid2": K.composite_key(df, ["card1", "addr1", "D1"]),
        "uid3": K.composite_key(df, [c for c in cfg.card_cols if c in here]),
        "uid4": K.composite_key(df, ["card1", "P_emaildomain"]),
    })


def aggregation_features(
    df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY,
    profiles: A.Profiles | None = None,
) -> DataFrame:
    """Frequencies and amount statistics per value."""
    return _profiled(
        df, cfg, policy, profiles, frequency=cfg.frequency_cols, amounts=cfg.amount_stat_cols
    )


def uid_aggregations(
    df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY,
    profiles: A.Profiles | None = None,
) -> DataFrame:
    return _profiled(df, cfg, policy, profiles, uids=cfg.uid_cols)


def enhanced_frequency_features(
    df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY,
    profiles: A.Profiles | None = None,
) -> DataFrame:
    return _profiled(df, cfg, policy, profiles, normalised=cfg.normalised_frequency_cols)


def _profiled(df, cfg, policy, profiles, **sets) -> DataFrame:
    """Attach sets of fitted statistics, fitting them on `df` itself when none are given."""
    policy = policy.settled(df)
    df = spread_small(df, cfg.id_col, policy)
    keys = list(dict.fromkeys(c for cols in sets.values() for c in cols))
    profiles = profiles or A.fit_profiles(df, keys, cfg.amount_col, "D1" if "D1" in df.schema.names else None)
    return on_projection(
        df, [*keys, cfg.amount_col],
        lambda part: A.profile_features(part, profiles, cfg.amount_col, policy=policy, **sets),
        cfg.id_col, policy,
    )


def velocity_features(
    train: DataFrame, test: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY
) -> tuple[DataFrame, DataFrame]:
    """User velocity over training and scoring rows together."""
    from ..operators.setops import joint_features

    return joint_features(train, test, lambda both: uid_velocity(both, cfg=cfg, policy=policy))


# ---- the whole chain -----------------------------------------------------------------------

@dataclass(frozen=True)
class FittedFeatures:
    """What scoring needs from the training rows."""

    profiles: A.Profiles
    rates: A.TargetRates | None
    repeats: DataFrame | None = None  # (card_id, amount, amt_repeat_count)
    scores: DataFrame | None = None   # (user_id, __m, __s, __n)


def _profile_keys(cfg: FeatureConfig) -> list[str]:
    return list(dict.fromkeys([
        "card_id", *cfg.frequency_cols, *cfg.amount_stat_cols, *cfg.uid_cols, *cfg.normalised_frequency_cols,
    ]))


def keyed_columns(df: DataFrame, cfg: FeatureConfig = DEFAULT) -> DataFrame:
    """Narrow frame with the keys the statistics are fitted on; needs no window."""
    df = uid_features(email_scalars(card_texts(with_card_id(df, cfg), cfg), cfg), cfg)
    here = set(df.schema.names)
    wanted = [cfg.id_col, cfg.amount_col, "D1", cfg.target_col, *_profile_keys(cfg)]
    return df.select(*[c for c in wanted if c in here])


def fit_features(df: DataFrame, cfg: FeatureConfig = DEFAULT, fold: Column | None = None, policy: SkewPolicy = DEFAULT_POLICY) -> FittedFeatures:
    """Fit every statistic on training rows: one pass for the keys, one for the target rates."""
    narrow = spread_small(keyed_columns(df, cfg), cfg.id_col, policy)
    profiles = A.fit_profiles(narrow, _profile_keys(cfg), cfg.amount_col, "D1")
    rates = None
    if cfg.target_col in df.schema.names:
        fold = A.hash_fold(cfg.id_col, cfg.folds) if fold is None else fold
        rates = A.fit_target_rates(narrow, cfg.email_cols[0], cfg.target_col, fold)
    amt = cfg.amount_col
    repeats = narrow.dropna(subset=["card_id", amt]).groupBy("card_id", amt).agg(F.count(F.lit(1)).alias("amt_repeat_count"))
    scores = None
    if "user_id" in df.schema.names:
        scores = materialise(df.dropna(subset=["user_id"]).groupBy("user_id").agg(F.avg(amt).alias("__m"), F.stddev_samp(amt).alias("__s"), F.count(F.lit(1)).alias("__n")))
    return FittedFeatures(profiles, rates, materialise(repeats), scores)


def _row_features(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Features of a row alone: no shuffle, whatever the width."""
    df = time_scalars(amount_scalars(df, cfg), cfg)
    df = device_features(df, cfg)
    return id_features(v_features(address_features(df, cfg), cfg), cfg)


def _looked_up(
    df: DataFrame, cfg: FeatureConfig, policy: SkewPolicy, fitted: FittedFeatures, fold: Column | None, ready: list[str]
) -> DataFrame:
    """Fitted statistics of a row's card, domain and users; those of the `ready` columns are in `df` already."""
    amt = cfg.amount_col
    if fitted.repeats is None:
        df = A.group_lookup(df, ["card_id", amt], {"amt_repeat_count": F.count(F.lit(1))}, policy)
    elif amt not in ready:
        df = A.counted_lookup(df.drop("amt_repeat_count"), fitted.repeats, ["card_id", amt], "amt_repeat_count", policy, cfg.id_col)
    if "user_id" in df.schema.names:
        if fitted.scores is None:
            df = A.zscore_by(df, "user_id", amt, "amount_zscore", policy)
        else:
            df = A.counted_lookup(df.drop("__m", "__s", "__n"), fitted.scores, ["user_id"], "__n", policy, cfg.id_col)
            df = add(df, {"amount_zscore": S.ratio(f"({amt} - __m)", "__s", 1.0)}, drop=("__m", "__s", "__n"))
    df = _spelled(df, cfg)
    if fitted.rates is None:
        df = add(df, {"P_domain_fraud_rate": "0D"})
    else:
        df = A.target_rate_feature(df, fitted.rates, "P_domain_fraud_rate", fold, policy)
    return A.profile_features(df, fitted.profiles, amt, policy=policy, ready=ready, **_statistic_sets(cfg))


def _spelled(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """The text columns of a row: cards, keys, e-mail domains and users."""
    return uid_features(email_scalars(_card_columns(df, cfg), cfg), cfg)


def _statistic_sets(cfg: FeatureConfig) -> dict:
    payer, receiver = cfg.email_cols
    return {
        "counts": {"card_id": "card_id_count", "addr1": "card_add_count", payer: "P_domain_count", receiver: "R_domain_count"},
        "frequency": cfg.frequency_cols, "normalised": cfg.normalised_frequency_cols, "amounts": cfg.amount_stat_cols, "uids": cfg.uid_cols,
    }


def _large_statistics(df: DataFrame, given: DataFrame, cfg: FeatureConfig, policy: SkewPolicy, fitted: FittedFeatures) -> tuple[DataFrame, list[str]]:
    """Fitted tables beyond the broadcast limit, looked up by ids and keys alone and joined by id, before the rows are widened by texts and other
    statistics. Only where the ids of the rows given are present and unique. Also returns the columns that are done (the amount stands for the repeats)."""
    id_col, amt, done = cfg.id_col, cfg.amount_col, []
    wanted = A.wanted_statistics(_spelled(df, cfg).schema.names, amt, **_statistic_sets(cfg))
    large = A.large_keys(fitted.profiles, wanted, policy)
    size = fitted.repeats.agg(F.count(F.lit(1)).alias("keys"), F.sum("amt_repeat_count").alias("rows")).first() if fitted.repeats is not None else None
    repeats = size is not None and size["keys"] * policy.row_bytes > policy.broadcast_bytes
    if not (large or repeats) or not unique_ids(given, id_col, policy):
        return df, []
    out, given = df, read_once(given)  # the keys are texts of the given rows alone, whatever `df` has been joined with
    rows, texts = given.count(), _spelled(with_card_id(given, cfg), cfg)
    if repeats:
        found = A.counted_lookup(with_card_id(given, cfg).select(id_col, "card_id", amt), fitted.repeats, ["card_id", amt], "amt_repeat_count", policy, id_col)
        # grouped, so that Spark knows the ids to be unique and leaves the join out where only other columns are read
        found = found.groupBy(id_col).agg(F.max("amt_repeat_count").alias("amt_repeat_count"))
        out, done = out.drop("amt_repeat_count").join(hashed(found, policy, rows), id_col, "left"), [amt]
    if large:
        values = {c: A.number_text(f"`{c}`", texts.schema[c].dataType) for c in large}
        found = A.statistics_by_id(texts, values, fitted.profiles, {c: wanted[c] for c in large}, policy, id_col)
        out = out.drop(*found.columns[1:]).join(hashed(found, policy, rows), id_col, "left")
    # the order of columns decides the one of the features: as `counted_lookup` of all rows leaves them
    first = ["card_id", amt] if repeats and size["rows"] <= policy.hot_rows else []
    return out.select(*dict.fromkeys([*first, *[c for c in df.columns if c in out.columns], *out.columns])), [*done, *large]


_ASIDE = "__row_"  # columns of a row that features of other rows neither read nor replace


@dataclass(frozen=True)
class ChainBase:
    """Rows with what the chain exchanges rows for: their card's sequence and the statistics beyond the broadcast limit (of the `ready`
    columns). `given` are the rows it was asked for; `aside` says that their other columns are renamed meanwhile."""

    rows: DataFrame
    ready: list[str]
    given: DataFrame
    aside: bool


def _keyed_names(df: DataFrame, cfg: FeatureConfig) -> list[str]:
    """Columns of `df` that features of other rows are made from."""
    wanted = [*_order(cfg), cfg.amount_col, *cfg.card_cols, *cfg.frequency_cols, "D1", "user_id", cfg.target_col]
    return [c for c in dict.fromkeys(wanted) if c in df.schema.names]


def card_rows(
    df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY, history: DataFrame | None = None, keep=()
) -> DataFrame:
    """The few columns that a card's sequence needs (and those to `keep`), with what `card_sequence` adds; stored."""
    part = df.select(*_sequence_names(df, cfg), *keep)
    return materialise(with_history(part, history, lambda rows: card_sequence(with_card_id(rows, cfg), cfg, policy), cfg), "zstd")


def _sequence_names(df: DataFrame, cfg: FeatureConfig) -> list[str]:
    wanted = [*_order(cfg), cfg.amount_col, *cfg.card_cols, "ProductCD"]
    return [c for c in dict.fromkeys(wanted) if c in df.schema.names]


def sequence_apart(df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY) -> bool:
    """Whether few of a frame's columns should go to their cards: it is wide, or large and has more than twice the columns needed."""
    if len(df.columns) > policy.narrow_over:
        return True
    return "card_id" not in df.columns and len(df.columns) > 2 * len(_sequence_names(df, cfg)) and input_bytes(df) > policy.broadcast_bytes


def chain_base(
    df: DataFrame, cfg: FeatureConfig, policy: SkewPolicy, fitted: FittedFeatures, history: DataFrame | None = None, sequence: DataFrame | None = None
) -> ChainBase:
    """All exchanges of the chain. Only the columns of `card_rows` go to their cards (`sequence_apart`); they come back by id (`sequence`, if the
    caller has them stored), with the large statistics, before a row is widened. Frames whose ids are missing or repeat are worked on whole."""
    if sequence is None and not (sequence_apart(df, cfg, policy) and unique_ids(df, cfg.id_col, policy)):
        whole = with_history(df, history, lambda rows: card_sequence(with_card_id(rows, cfg), cfg, policy), cfg)
        rows, ready = _large_statistics(whole, df, cfg, policy, fitted)
        return ChainBase(rows, ready, df, False)
    wide, policy = len(df.columns) > policy.narrow_over, replace(policy, unique_ids=True)
    sequence = card_rows(df, cfg, policy, history) if sequence is None else sequence
    part, keyed = _sequence_names(df, cfg), _keyed_names(df, cfg) if wide else df.columns
    fresh = [c for c in sequence.columns if c not in part]
    rows = df.select(*[F.col(f"`{c}`").alias(c if c in keyed else _ASIDE + c) for c in df.columns if wide or c not in fresh])
    joined = rows.join(hashed(sequence.select(cfg.id_col, *fresh), policy, sequence.count()), cfg.id_col, "left")
    # the order of columns decides the one of the features: as the sequence of all keyed columns has them
    first = sequence.columns[:2] if sequence.columns[0] == "card_id" else []
    order = dict.fromkeys([*first, *[c for c in keyed if c not in fresh], *sequence.columns, *joined.columns])
    rows, ready = _large_statistics(joined.select(*[f"`{c}`" for c in order]), df.select(*keyed), cfg, policy, fitted)
    return ChainBase(rows, ready, df, wide)


def chain_rows(
    base: ChainBase, cfg: FeatureConfig, policy: SkewPolicy, fitted: FittedFeatures, training: bool = True, fold: Column | None = None
) -> DataFrame:
    """The features of the base's rows; nothing is exchanged unless ids repeat."""
    training = training and fitted.rates is not None
    fold = (A.hash_fold(cfg.id_col, cfg.folds) if fold is None else fold) if training else None
    keyed = _looked_up(base.rows, cfg, policy, fitted, fold, base.ready)
    if not base.aside:
        return _row_features(keyed, cfg)
    here, replaced, own = base.given.columns, {*cfg.card_cols, *cfg.email_cols}, _keyed_names(base.given, cfg)
    fresh = [c for c in keyed.columns if not c.startswith(_ASIDE) and (c not in here or c in replaced)]
    back = [F.col(f"`{c}`" if c in own else f"`{_ASIDE}{c}`").alias(c) for c in here if c not in fresh]
    wide = _row_features(keyed.select(*back, *[f"`{c}`" for c in fresh]), cfg)
    names = [cfg.id_col, *[c for c in wide.columns if c not in fresh], *fresh]
    return wide.select(*[f"`{c}`" for c in dict.fromkeys(names)])


def feature_chain(
    df: DataFrame, cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY,
    fitted: FittedFeatures | None = None, training: bool = True, fold: Column | None = None, history: DataFrame | None = None,
) -> DataFrame:
    """All feature sets at once.

    `history` holds rows of the same cards outside `df` (other splits, what was scored before): previous amounts, gaps, medians,
    fills and velocities look back into it. Fitted counts and means never come from the scored rows.

    With `fitted` the statistics come from the training rows; without, from `df` itself.
    Training rows get out-of-fold target rates, scoring rows the fitted rates. A wide frame is
    read twice, once for its own columns and once for the few columns that are shuffled, and
    joined by id once; chaining the single sets would repeat that for each of them. Frames whose
    ids are missing or repeat cannot be joined back and are worked on whole.
    """
    policy = policy.settled(df)
    fitted = fitted or fit_features(df, cfg, fold, policy)
    return chain_rows(chain_base(df, cfg, policy, fitted, history), cfg, policy, fitted, training, fold)
