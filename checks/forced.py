"""Queries that force the paths of large and of wide inputs; each is compared with the SQL of its plain form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import metrics
from ledgerlens.operators.ordered import ordered_features
from ledgerlens.operators.skew import SkewPolicy
from ledgerlens.plans import features as G

from .base import ORACLE, QUERIES, R, check, raw, tidy, txn
from .feature_sets import CHAIN, names
from .ordered import carded, with_uids

ID = "TransactionID"
#: Everything is large: keys above 500 rows are split into blocks of 200.
LARGE = SkewPolicy(small_bytes=0, hot_rows=500, block_rows=200, slice_rows=3000)
#: Every frame is wide.
WIDE = SkewPolicy(narrow_over=0)


def forced(name: str, plain: str, doubles=()):
    def wrap(build):
        QUERIES[name] = lambda spark, folder: tidy(build(spark, folder), doubles)
        ORACLE[name] = ORACLE[plain]
        return build

    return wrap


@forced("g14_feature_chain_wide", "g14_feature_chain", ("addr1_freq",))
def chain_wide(s, d):
    return G.feature_chain(raw(s, d), policy=WIDE, fold=F.col(ID) % 5).select(ID, *names(CHAIN))


@forced("a19_average_precision_large", "a19_average_precision")
def average_precision_large(s, d):
    return metrics.ranking_quality(txn(s, d), "isFraud", "score", ["card6"], LARGE)


@forced("w5_transactions_last_hour_large", "w5_transactions_last_hour")
def last_hour_large(s, d):
    return G.time_history(carded(s, d), policy=LARGE).select(ID, "Transaction_cnt_1hr")


@forced("w1_previous_amount_large", "w1_previous_amount")
def previous_amount_large(s, d):
    return G.amount_history(carded(s, d), policy=LARGE).select(ID, "card_id", "prev_amount")


@forced("g13_velocity_features_wide", "g13_velocity_features")
def velocity_wide(s, d):
    from .feature_sets import G13

    return G.uid_velocity(with_uids(s, d), policy=WIDE).select(ID, *names(G13))


@check(
    "w1_previous_amount_missing_key_large",
    f"WITH k AS (SELECT {ID}, TransactionDT, TransactionAmt, ProductCD, CASE WHEN {ID} % 3 = 0 THEN NULL ELSE card1 END AS k FROM txn) "
    f"SELECT {ID}, k, {R('coalesce(lag(TransactionAmt) OVER w, TransactionAmt)', 'before')}, last_value(ProductCD IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled, "
    "row_number() OVER w - 1 AS place FROM k WINDOW w AS (PARTITION BY k ORDER BY TransactionDT, TransactionID)",
)
def missing_key_large(s, d):
    """A third of the rows has no key: they are a group of their own and are split over tasks."""
    df = txn(s, d).selectExpr(ID, "TransactionDT", "TransactionAmt", "ProductCD", f"IF({ID} % 3 = 0, NULL, card1) AS k")
    lagged = {"before": "coalesce(lag(TransactionAmt) OVER ({w}), TransactionAmt)"}
    out = ordered_features(df, "k", ["TransactionDT", ID], lagged, {"filled": "ProductCD"}, "place", policy=LARGE)
    return out.select(ID, "k", "before", "filled", "place")
