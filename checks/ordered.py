"""W rows: windows per card and user; O rows: sorts, limits and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import eda, stats
from ledgerlens.plans import features as G
from ledgerlens.streaming import drift

from .base import AMT, CARDED, DT, W_CARD, WITH_UIDS, B, R, check, flag, predictions, txn

ID = "TransactionID"
PREV = f"coalesce(lag({AMT}) OVER ({W_CARD}), {AMT})"
MEDIAN = f"coalesce(quantile_cont({AMT}, 0.5) OVER ({W_CARD} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), {AMT})"
GAP = f"coalesce({DT} - lag({DT}) OVER ({W_CARD}), 999999)"
VELOCITY = f"count(*) OVER (PARTITION BY card_id ORDER BY {DT} RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW)"
FILLED = f"last_value(ProductCD IGNORE NULLS) OVER ({W_CARD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def carded(s, d):
    return G.with_card_id(txn(s, d))


def with_uids(s, d):
    return G.uid_features(G.email_scalars(G.card_texts(carded(s, d))))


@check("w1_previous_amount", f"WITH {CARDED} SELECT {ID}, card_id, {R(PREV, 'prev_amount')} FROM c")
def previous_amount(s, d):
    return G.amount_history(carded(s, d)).select(ID, "card_id", "prev_amount")


@check(
    "w2_amount_jump_and_spike",
    f"WITH {CARDED}, p AS (SELECT *, {PREV} AS prev FROM c) "
    f"SELECT {ID}, {R(f'{AMT} / nullif(prev + 1, 0)', 'amount_jump_ratio')}, {flag(f'{AMT} / nullif(prev + 1, 0) > 5', 'is_amount_spike')} FROM p",
)
def amount_jump(s, d):
    return G.amount_history(carded(s, d)).select(ID, "amount_jump_ratio", "is_amount_spike")


@check(
    "w3_rolling_median",
    f"WITH {CARDED}, m AS (SELECT *, {MEDIAN} AS med FROM c) "
    f"SELECT {ID}, {R('med', 'rolling_median_amt')}, {R(f'{AMT} / (med + 1)', 'amt_vs_rolling')} FROM m",
)
def rolling_median(s, d):
    return G.amount_history(carded(s, d)).select(ID, "rolling_median_amt", "amt_vs_rolling")


@check("w4_time_gap", f"WITH {CARDED} SELECT {ID}, {B(GAP, 'Transaction_time_gap')} FROM c")
def time_gap(s, d):
    return G.time_history(carded(s, d)).select(ID, "Transaction_time_gap")


@check("w5_transactions_last_hour", f"WITH {CARDED} SELECT {ID}, {B(VELOCITY, 'Transaction_cnt_1hr')} FROM c")
def last_hour(s, d):
    return G.time_history(carded(s, d)).select(ID, "Transaction_cnt_1hr")


def uid_window(u):
    return f"PARTITION BY {u} ORDER BY {DT}, {ID}"


def since(u):
    return f"coalesce({DT} - lag({DT}) OVER ({uid_window(u)}), 999999)"


@check(
    "w6_uid_time_since_last",
    f"WITH {WITH_UIDS} SELECT {ID}, "
    + ", ".join(f"{B(since(u), f'{u}_time_since_last')}, {flag(f'{since(u)} < 3600', f'{u}_is_rapid')}" for u in ("uid1", "uid2"))
    + " FROM u",
)
def uid_since(s, d):
    return G.uid_velocity(with_uids(s, d)).select(
        ID, "uid1_time_since_last", "uid1_is_rapid", "uid2_time_since_last", "uid2_is_rapid"
    )


@check(
    "w7_uid_running_index",
    f"WITH {WITH_UIDS} SELECT {ID}, "
    + ", ".join(B(f"row_number() OVER ({uid_window(u)}) - 1", f"{u}_trans_in_session") for u in ("uid1", "uid2")) + " FROM u",
)
def uid_index(s, d):
    return G.uid_velocity(with_uids(s, d)).select(ID, "uid1_trans_in_session", "uid2_trans_in_session")


@check("w8_product_forward_fill", f"WITH {CARDED} SELECT {ID}, {FILLED} AS ProductCD_filled FROM c")
def product_fill(s, d):
    return G.product_filled(carded(s, d)).select(ID, "ProductCD_filled")


@check(
    "w9_last_predictions",
    f"SELECT seq, sec, model_version, {R('prob', 'prob')} FROM (SELECT *, row_number() OVER (PARTITION BY model_version ORDER BY sec DESC, seq DESC) AS k FROM prediction_log) WHERE k <= 1000",
    ("prediction_log",),
)
def last_predictions(s, d):
    return drift.recent_rows(predictions(s, d), by="model_version").select("seq", "sec", "model_version", "prob")


_LAST = "PARTITION BY model_version ORDER BY sec, seq ROWS BETWEEN 999 PRECEDING AND CURRENT ROW"


@check(
    "w9_rolling_alert_rate",
    f"SELECT seq, {B(f'count(*) OVER ({_LAST})', 'rows_in_window')}, {R(f'avg(CASE WHEN prob > 0.5 THEN 1 ELSE 0 END) OVER ({_LAST})', 'rate_in_window')} FROM prediction_log",
    ("prediction_log",),
)
def rolling_alert_rate(s, d):
    return drift.rolling_rates(predictions(s, d)).select("seq", "rows_in_window", "rate_in_window")


@check(
    "w10_partition_statistics",
    f"WITH {CARDED} SELECT {ID}, {B('count(*) OVER (PARTITION BY card_id)', 'n')}, {R(f'avg({AMT}) OVER (PARTITION BY card_id)', 'mean_amt')}, "
    f"{R(f'stddev_samp({AMT}) OVER (PARTITION BY card_id)', 'std_amt')} FROM c",
)
def partition_statistics(s, d):
    return stats.group_lookup(
        carded(s, d), ["card_id"],
        {"n": F.count(F.lit(1)), "mean_amt": F.avg(AMT), "std_amt": F.stddev_samp(AMT)},
    ).select(ID, "n", "mean_amt", "std_amt")


# ---- sorts, limits, top-k ---------------------------------------------------------------------

@check("o1_sort_by_card_and_time", f"WITH {CARDED} SELECT {ID}, card_id, {DT} FROM c ORDER BY card_id, {DT}, {ID}")
def sort_card_time(s, d):
    return carded(s, d).select(ID, "card_id", DT).orderBy("card_id", DT, ID)


@check("o2_sort_by_time_with_index", f"SELECT {ID}, {DT}, row_number() OVER (ORDER BY {DT}, {ID}) AS row_index FROM txn")
def sort_time(s, d):
    from ledgerlens.operators.ordered import dense_position

    return dense_position(txn(s, d).select(ID, DT), [DT, ID], name="row_index")


RISK = f"{R('avg(isFraud)', 'fraud_rate')}, {B('count(isFraud)', 'volume')}, {B('sum(isFraud)', 'frauds')}"


@check(
    "o3_risk_by_card_network",
    f"SELECT card4, card6, {RISK} FROM txn WHERE card4 IS NOT NULL AND card6 IS NOT NULL GROUP BY card4, card6 ORDER BY frauds DESC, card4, card6",
)
def risk_by_network(s, d):
    return eda.riskiest(txn(s, d), ["card4", "card6"])


@check(
    "o4_top_jump_cards",
    f"WITH {CARDED}, p AS (SELECT *, {AMT} / nullif({PREV} + 1, 0) AS jump FROM c) "
    f"SELECT card_id, {R('max(jump)', 'top_jump')}, {B('count(*)', 'rows')} FROM p GROUP BY card_id ORDER BY max(jump) DESC, card_id LIMIT 10",
)
def top_jump_cards(s, d):
    jumps = G.amount_history(carded(s, d))
    top = jumps.groupBy("card_id").agg(F.max("amount_jump_ratio").alias("top_jump"), F.count(F.lit(1)).alias("rows"))
    return top.orderBy(F.desc("top_jump"), "card_id").limit(10)


@check(
    "o4_top_risky_domains",
    f"SELECT P_emaildomain, {RISK} FROM txn WHERE P_emaildomain IS NOT NULL GROUP BY P_emaildomain ORDER BY frauds DESC, P_emaildomain LIMIT 10",
)
def top_domains(s, d):
    return eda.riskiest(txn(s, d), ["P_emaildomain"], top=10)


@check(
    "o5_top_groups_per_hour",
    f"SELECT hour, ProductCD, {R('total', 'total')}, {B('place', 'place')} FROM (SELECT *, row_number() OVER (PARTITION BY hour ORDER BY total DESC, ProductCD) AS place FROM "
    f"(SELECT CAST({DT} // 3600 AS BIGINT) AS hour, ProductCD, sum({AMT}) AS total FROM txn WHERE ProductCD IS NOT NULL GROUP BY 1, 2)) WHERE place <= 3",
)
def top_groups(s, d):
    rows = txn(s, d).where("ProductCD IS NOT NULL").selectExpr(f"{DT} DIV 3600 AS hour", "ProductCD", AMT)
    return eda.top_groups(rows, "ProductCD", AMT, 3, "hour")


@check(
    "o6_latest_version",
    "SELECT event_type AS model, CAST(max(event_id % 40) AS BIGINT) AS version FROM events GROUP BY event_type", (),
)
def latest_version(s, d):
    from ledgerlens.functions.scalars import version_number

    names = s.read.parquet(f"{d}/events.parquet").selectExpr("event_type AS model", "concat(event_type, '_v', event_id % 40) AS name")
    return names.groupBy("model").agg(F.expr(f"max({version_number('name')})").alias("version"))


def flagship(s, d):
    """Ten cards with the largest jump from one amount to the next."""
    return top_jump_cards(s, d)


# ---- a larger transaction shape: orders per customer --------------------------------------------

def orders_as_txn(s, d):
    return s.read.parquet(f"{d}/orders.parquet").selectExpr(
        "o_orderkey AS TransactionID",
        "timestampdiff(SECOND, TIMESTAMP_NTZ '1990-01-01 00:00:00', o_orderdate) AS TransactionDT",
        "o_totalprice AS TransactionAmt", "CAST(o_custkey AS STRING) AS card_id",
    )


_OW = "PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"


@check(
    "w3_rolling_median_orders",
    f"SELECT o_orderkey AS TransactionID, {R(f'coalesce(lag(o_totalprice) OVER ({_OW}), o_totalprice)', 'prev_amount')}, "
    f"{R(f'coalesce(quantile_cont(o_totalprice, 0.5) OVER ({_OW} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), o_totalprice)', 'rolling_median_amt')} FROM orders",
    (),
)
def rolling_median_orders(s, d):
    return G.amount_history(orders_as_txn(s, d)).select(ID, "prev_amount", "rolling_median_amt")
