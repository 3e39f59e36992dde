"""G rows: whole feature sets, and the SQL view over them (X1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import joins
from ledgerlens.operators.setops import stack_rows
from ledgerlens.plans import features as G
from ledgerlens.sources.event_views import load_view

from .base import AMT, CARDED, CARD_TEXTS, DT, EMAIL, UIDS, WITH_UIDS, B, R, check, flag, host_parts, ident, raw, txn
from .grouped import (
    AMT_COLS, BOTH, FREQ_COLS, ID_SQL, NORM, NORM_COLS, NORM_OUT, OOF, RAW, REPEAT, UID_COLS, UID_OUT,
    UID_RAW, V_OUT, V_SQL, amount_stats_sql, freq, uid_rows, uid_stats_sql,
    WIDE_ID_SQL, WIDE_V_SQL,
)
from .ordered import GAP, MEDIAN, PREV, VELOCITY, since, uid_window, with_uids
from .scalars import BIN_SQL, CARD_KEYS_SQL, DEVICE, HOUR, ID_FLAGS_SQL, MISSING, PRESENCE, SCREEN, SCREEN_INNER, STATUS, TOD

ID = "TransactionID"


def names(cols) -> list[str]:
    return [c.rsplit(" AS ", 1)[1] for c in cols]


G1 = [
    "card_id AS card_id", R(f"ln(1 + {AMT})", f"{AMT}_log"), B(f"trunc(({AMT} - trunc({AMT})) * 1000)", f"{AMT}_decimal"),
    flag(f"{AMT} = trunc({AMT})", f"{AMT}_is_round"), R(f"CAST({BIN_SQL} AS DOUBLE)", f"{AMT}_bins"),
    B(f"trunc(({AMT} * 100) % 100)", f"{AMT}_cents"), flag(f"{AMT} < 10", f"{AMT}_is_micro"), R("prev", "prev_amount"),
    R(f"{AMT} / nullif(prev + 1, 0)", "amount_jump_ratio"), flag(f"{AMT} / nullif(prev + 1, 0) > 5", "is_amount_spike"),
    R("med", "rolling_median_amt"), R(f"{AMT} / (med + 1)", "amt_vs_rolling"), B("rep", "amt_repeat_count"),
    R(f"({AMT} - avg({AMT}) OVER (PARTITION BY card1)) / (stddev_samp({AMT}) OVER (PARTITION BY card1) + 1)", "amount_zscore"),
]


@check(
    "g1_transaction_amount_features",
    f"WITH {CARDED}, h AS (SELECT *, CAST({AMT} AS FLOAT) AS a, {PREV} AS prev, {MEDIAN} AS med, {REPEAT} AS rep FROM c) SELECT {ID}, {', '.join(G1)} FROM h",
)
def amount(s, d):
    df = txn(s, d).withColumn("user_id", F.col("card1"))
    return G.transaction_amount_features(df).select(ID, *names(G1))


G2 = [
    B(HOUR, "Transaction_hour"), B(f"{DT} % 86400", "Transaction_sec_in_day"), B(TOD, "Transaction_time_of_day"),
    flag(f"{HOUR} < 6", "Transaction_is_night"), flag(f"{HOUR} BETWEEN 9 AND 17", "Transaction_is_business_hour"),
    R(f"sin(2 * pi() * {HOUR} / 24)", "Transaction_hour_sin"), R(f"cos(2 * pi() * {HOUR} / 24)", "Transaction_hour_cos"),
    B(GAP, "Transaction_time_gap"), B(VELOCITY, "Transaction_cnt_1hr"),
]


@check("g2_time_features", f"WITH {CARDED} SELECT {ID}, {', '.join(G2)} FROM c")
def time(s, d):
    return G.time_features(txn(s, d)).select(ID, *names(G2))


_texts = ", ".join(f"{sql} AS {c}" for c, sql in CARD_TEXTS.items())
_keys = ["card1_addrs1", "card1_addrs2", "card2_addrs1", "card1_ProductCD", "card2_ProductCD"]


@check(
    "g3_card_features",
    f"WITH {CARDED}, k AS ({CARD_KEYS_SQL}), n AS (SELECT {ID}, {_texts}, {B('count(*) OVER (PARTITION BY card_id)', 'card_id_count')}, {R(freq('addr1'), 'card_add_count')} FROM c) "
    f"SELECT n.*, {', '.join(_keys)} FROM n JOIN k USING ({ID})",
    doubles=("card_add_count",),
)
def card(s, d):
    return G.card_features(txn(s, d)).select(ID, *CARD_TEXTS, "card_id_count", "card_add_count", *_keys)


_p, _r = host_parts("p"), host_parts("r")
G4 = [
    "p AS P_emaildomain", "r AS R_emaildomain", f"{_p['vendor']} AS P_email_vendor", f"{_r['vendor']} AS R_email_vendor",
    f"{_p['tld']} AS P_email_tld", f"{_r['tld']} AS R_email_tld", flag("p = r", "email_domain_match"), f"{PRESENCE} AS email_presence",
    B("count(*) OVER (PARTITION BY p)", "P_domain_count"), B("count(*) OVER (PARTITION BY r)", "R_domain_count"),
]


@check(
    "g4_email_features",
    f"WITH {OOF.format(src='txn')}, h AS (SELECT {ID}, {EMAIL['P_emaildomain']} AS p, {EMAIL['R_emaildomain']} AS r FROM txn) "
    f"SELECT {ID}, {', '.join(G4)}, {R('rate', 'P_domain_fraud_rate')} FROM h JOIN oof USING ({ID})",
)
def email(s, d):
    return G.email_features(txn(s, d), fold=F.col(ID) % 5).select(ID, *names(G4), "P_domain_fraud_rate")


G5 = [*DEVICE["f16"], *DEVICE["f17"], *DEVICE["f18"], *DEVICE["f19"], *SCREEN]


@check("g5_device_features", f"WITH {RAW} SELECT {ID}, {', '.join(G5)} FROM ({SCREEN_INNER.format(src='r')})", BOTH)
def device(s, d):
    return G.device_features(raw(s, d)).select(ID, *names(G5))


G6 = [
    "concat(coalesce(CAST(addr1 AS VARCHAR), 'nan'), '_', coalesce(CAST(addr2 AS VARCHAR), 'nan')) AS addr1_addr2",
    "concat(coalesce(CAST(addr1 AS VARCHAR), 'nan'), '_', coalesce(ProductCD, 'nan')) AS addr1_ProductCD",
    *MISSING, R("ln(1 + coalesce(dist1, 0))", "dist1_log"), R("ln(1 + coalesce(dist2, 0))", "dist2_log"),
]


@check("g6_address_features", f"SELECT {ID}, {', '.join(G6)} FROM txn")
def address(s, d):
    return G.address_features(txn(s, d)).select(ID, *names(G6))


@check("g7_v_features", f"SELECT {ID}, {', '.join(V_SQL)} FROM txn")
def v_columns(s, d):
    return G.v_features(txn(s, d)).select(ID, *V_OUT)


G8_OUT = [f"{c}_freq" for c in FREQ_COLS] + [f"{c}_{AMT}_{k}" for c in AMT_COLS for k in ("mean", "std", "dev")]


@check(
    "g8_aggregation_features",
    f"WITH {RAW} SELECT {ID}, {', '.join(R(freq(c), f'{c}_freq') for c in FREQ_COLS)}, {amount_stats_sql(AMT_COLS)} FROM r", BOTH,
    [f"{c}_freq" for c in FREQ_COLS],
)
def aggregation(s, d):
    return G.aggregation_features(raw(s, d)).select(ID, *G8_OUT)


G9 = [*ID_SQL, *ID_FLAGS_SQL, STATUS]


@check("g9_id_features", f"SELECT {ID}, {', '.join(G9)} FROM ident", ("ident",))
def identity(s, d):
    return G.id_features(ident(s, d)).select(ID, *names(G9))


# flags of missing values are 0, a status without a number is -1
WIDE_G9 = [*WIDE_ID_SQL, *ID_FLAGS_SQL, STATUS]


@check("g9_id_features_every_column", f"SELECT {ID}, {', '.join(WIDE_G9)} FROM ident_wide", ("ident_wide",))
def every_identity_column(s, d):
    return G.id_features(load_view(s, d, "ident_wide")).select(ID, *names(WIDE_G9))


@check(
    "g7_v_features_of_identified_rows",
    f"SELECT {ID}, {', '.join(WIDE_V_SQL)}, {', '.join(WIDE_G9)} FROM (SELECT v.*, i.* EXCLUDE ({ID}) FROM txn_wide v LEFT JOIN ident_wide i USING ({ID}))",
    ("txn_wide", "ident_wide"),
)
def wide_sets_together(s, d):
    both = joins.merge_identity(load_view(s, d, "txn_wide"), load_view(s, d, "ident_wide"))
    return G.id_features(G.v_features(both)).select(ID, *names(WIDE_V_SQL), *names(WIDE_G9))


@check("g10_uid_features", f"SELECT {ID}, " + ", ".join(f"{sql} AS {n}" for n, sql in UIDS.items()) + " FROM txn")
def uids(s, d):
    return with_uids(s, d).select(ID, *UIDS)


@check("g11_uid_aggregations", f"WITH {WITH_UIDS} SELECT {ID}, {', '.join(uid_stats_sql(u) for u in UID_COLS)} FROM u")
def uid_aggregations(s, d):
    return G.uid_aggregations(with_uids(s, d)).select(ID, *UID_OUT)


@check(
    "g12_enhanced_frequency_features", f"WITH {WITH_UIDS}, {UID_RAW} SELECT {ID}, {NORM} FROM r", BOTH,
    [f"{c}_freq" for c in NORM_COLS],
)
def enhanced_frequency(s, d):
    return G.enhanced_frequency_features(uid_rows(s, d)).select(ID, *NORM_OUT)


G13 = [
    col for u in ("uid1", "uid2") for col in (
        B(since(u), f"{u}_time_since_last"), flag(f"{since(u)} < 3600", f"{u}_is_rapid"),
        B(f"row_number() OVER ({uid_window(u)}) - 1", f"{u}_trans_in_session"),
    )
]


@check("g13_velocity_features", f"WITH {WITH_UIDS} SELECT {ID}, {', '.join(G13)} FROM u")
def velocity(s, d):
    df = with_uids(s, d)
    train, test = G.velocity_features(df.where(F.col(ID) % 5 != 0), df.where(F.col(ID) % 5 == 0))
    return stack_rows(train, test).select(ID, *names(G13))


def chained(s, d):
    return G.feature_chain(raw(s, d), fold=F.col(ID) % 5)


CHAIN = [
    R(f"{AMT} / nullif(prev + 1, 0)", "amount_jump_ratio"), R("med", "rolling_median_amt"), B(GAP, "Transaction_time_gap"),
    B(VELOCITY, "Transaction_cnt_1hr"), B("rep", "amt_repeat_count"), B("count(*) OVER (PARTITION BY card_id)", "card_id_count"),
    R("rate", "P_domain_fraud_rate"), *DEVICE["f16"], DEVICE["f17"][0], *MISSING, V_SQL[0], V_SQL[2], ID_FLAGS_SQL[0], STATUS,
    R(freq("addr1"), "addr1_freq"), B(f"count(*) OVER (PARTITION BY {UIDS['uid2']})", "uid2_count"),
    R(f"{AMT} / (avg({AMT}) OVER (PARTITION BY {UIDS['uid4']}) + 0.001)", f"uid4_{AMT}_to_mean"),
    R(f"avg(D1) OVER (PARTITION BY {UIDS['uid3']})", "uid3_D1_mean"),
    R(f"count(*) OVER (PARTITION BY {UIDS['uid1']}) / CAST(count(*) OVER () AS DOUBLE)", "uid1_freq_norm"),
]


@check(
    "g14_feature_chain",
    f"WITH {RAW}, c AS (SELECT *, {CARDED.split('SELECT *, ')[1].rsplit(' AS card_id', 1)[0]} AS card_id FROM r), {OOF.format(src='txn')}, "
    f"h AS (SELECT c.*, {PREV} AS prev, {MEDIAN} AS med, {REPEAT} AS rep, rate FROM c JOIN oof USING ({ID})) "
    f"SELECT {ID}, {', '.join(CHAIN)} FROM h",
    BOTH, ("addr1_freq",),
)
def chain(s, d):
    return chained(s, d).select(ID, *names(CHAIN))


@check("g14_feature_chain_all_columns")
def chain_all(s, d):
    return chained(s, d)


@check(
    "x1_features_in_sql",
    f"WITH {CARDED}, h AS (SELECT *, {AMT} / nullif({PREV} + 1, 0) AS jump FROM c) SELECT ProductCD, count(*) AS rows, {B('sum(CASE WHEN jump > 5 THEN 1 ELSE 0 END)', 'spikes')}, {R('max(jump)', 'top_jump')} FROM h GROUP BY ProductCD",
)
def features_in_sql(s, d):
    from ledgerlens.plans.surface import register_features

    view = register_features(txn(s, d), ["amount"], prefix="x1_")["amount"]
    return s.sql(f"SELECT ProductCD, count(*) AS rows, sum(is_amount_spike) AS spikes, max(amount_jump_ratio) AS top_jump FROM {view} GROUP BY ProductCD")
