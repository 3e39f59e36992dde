"""Lookups beyond the broadcast limit: same rows and few exchanges."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import joins, ordered, stats
from ledgerlens.operators.skew import SkewPolicy
from ledgerlens.session import materialise, read_once
from ledgerlens.plans import features as G
from ledgerlens.plans import model as M
from ledgerlens.plans import prepare as P
from conftest import frame

LARGE = SkewPolicy(small_bytes=0, broadcast_bytes=2000, hot_rows=250)
KEYS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def keyed(spark):
    """Three keys of over 64 values each, one of them null at times, one with a value that holds a third of the rows."""
    return materialise(spark.range(900).selectExpr(
        "id AS TransactionID", "CAST(id % 90 AS STRING) AS a", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('b', id % 200) END AS b",
        "CASE WHEN id % 7 > 0 THEN concat('c', id % 110) END AS c", "CAST(id % 13 AS DOUBLE) AS amount", "CAST(id % 5 AS DOUBLE) AS D1",
    ))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def wide_joins(df, columns):
    """Left joins in the plan that the rows with their own columns go through."""
    return plan(df).count("Join LeftOuter") if columns <= set(df.columns) else -1


WANTED = {k: {f"{k}_n": "n", f"{k}_mean": "amt_mean"} for k in KEYS}


def test_profiles_of_many_large_keys_in_one_exchange(keyed):
    fitted = stats.fit_profiles(keyed, KEYS, "amount", "D1")
    plain, large = stats.attach_profiles(keyed, fitted, WANTED), stats.attach_profiles(keyed, fitted, WANTED, LARGE)
    assert plain.columns == large.columns
    assert frame(plain, "TransactionID").equals(frame(large, "TransactionID"))
    one = stats.attach_profiles(keyed, fitted, {"a": WANTED["a"], "b": WANTED["b"]}, LARGE)
    assert wide_joins(large, set(keyed.columns)) == wide_joins(one, set(keyed.columns))  # a third key adds no join


def test_profiles_with_repeated_ids_keep_every_row(keyed):
    twice = keyed.unionByName(keyed.where("TransactionID < 50")).withColumn("TransactionID", F.expr("nullif(TransactionID, 3)"))
    fitted = stats.fit_profiles(keyed, KEYS, "amount", "D1")
    kept = [*keyed.columns, *[o for per in WANTED.values() for o in per]]
    plain, large = (sorted(map(str, stats.attach_profiles(twice, fitted, WANTED, p).select(*kept).collect())) for p in (SkewPolicy(), LARGE))
    assert plain == large and len(large) == 950


def test_large_identity_side_is_hashed(keyed, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = joins.merge_identity(keyed, keyed.select("TransactionID", F.col("amount").alias("id_01")), policy=LARGE)
        text = both._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_codes_of_many_large_dictionaries(keyed):
    fitted = P.fit_dictionaries(keyed, KEYS)
    plain, large = (P.encode(keyed, fitted, KEYS, -999.0, -1.0, p) for p in (SkewPolicy(), LARGE))
    assert frame(plain, "TransactionID").equals(frame(large, "TransactionID"))


def test_rows_from_several_tables_are_stored_once(keyed):
    both = keyed.join(keyed.select("TransactionID", F.col("amount").alias("other")), "TransactionID")
    assert read_once(keyed) is keyed
    assert read_once(both).inputFiles() and "Join" not in plan(read_once(both))


def test_shares_too_large_to_hash_are_sorted(keyed):
    tight = SkewPolicy(small_bytes=0, broadcast_bytes=2000, hot_rows=250, hash_bytes=100)
    both = joins.merge_identity(keyed, keyed.select("TransactionID", F.col("amount").alias("id_01")), policy=tight)
    assert "shuffle_hash" not in plan(both)
    assert frame(both, "TransactionID")["id_01"].tolist() == frame(keyed, "TransactionID")["amount"].tolist()


def exchanges(df):
    """Columns of every exchange in the plan."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.initialPlan())
            continue
        if node.nodeName() == "Exchange":
            found.append(node.output().size())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.fixture(scope="module")
def payments(spark):
    return materialise(spark.range(700).selectExpr(
        "id AS TransactionID", "id * 40 % 9000 AS TransactionDT", "CAST(id % 83 AS DOUBLE) AS TransactionAmt", "CASE WHEN id % 9 > 0 THEN 'W' END AS ProductCD",
        "1000 + id % 75 AS card1", "CAST(id % 5 AS DOUBLE) AS card2", "CASE WHEN id % 4 > 0 THEN 'visa' END AS card4", "CAST(id % 3 AS DOUBLE) AS addr1",
        "CAST(id % 4 AS DOUBLE) AS D1", "CASE WHEN id % 6 > 0 THEN 'gmail.com' END AS P_emaildomain", "'yahoo.com' AS R_emaildomain",
        "CAST(id % 7 AS DOUBLE) AS V1", "CAST(id * id % 11 AS DOUBLE) AS V2", "CAST(id % 10 = 0 AS INT) AS isFraud",
    ))


def test_rows_are_exchanged_before_they_are_wide(payments):
    train, test = payments.where("TransactionID % 5 > 0"), payments.where("TransactionID % 5 = 0")
    plain, large = (M.prepare_sets(train, test, policy=p) for p in (SkewPolicy(), LARGE))
    named = lambda s: [*s[1].numbers, *s[1].texts]  # the two plans order them differently
    assert sorted(named(plain)) == sorted(named(large))
    for k in (2, 3):
        parts = []
        for s in (plain, large):
            f = P.vector_to_array("features")
            parts.append(frame(s[k].select("TransactionID", *[f[i].alias(c + "_code") for i, c in sorted(enumerate(named(s)), key=lambda x: x[1])]), "TransactionID"))
        assert parts[0].round(6).equals(parts[1].round(6))
    rows = G.feature_chain(test, policy=LARGE, fitted=large[0], training=False, history=train)
    assert len(rows.columns) > 100 and max(exchanges(large[1].transform(rows, LARGE))) < 40


def test_velocity_without_hot_keys_needs_no_exchange_of_its_own(payments):
    cards = G.with_card_id(payments)
    calm = SkewPolicy(small_bytes=0)
    once = ordered.ordered_features(cards, "card_id", ["TransactionDT", "TransactionID"], {"before": "lag(TransactionAmt) OVER ({w})"}, policy=calm)
    counted = ordered.recent_count(once, "card_id", "TransactionDT", 3600, "n", calm, cards)
    assert len(exchanges(counted)) == len(exchanges(once)) == 1
    again = ordered.recent_count(cards, "card_id", "TransactionDT", 3600, "n", SkewPolicy(small_bytes=0, hot_rows=5))
    assert frame(counted.select("TransactionID", "n"), "TransactionID").equals(frame(again.select("TransactionID", "n"), "TransactionID"))


def with_more_columns(payments):
    """More than twice the columns that a card's sequence needs; one of them is named like a feature."""
    return payments.selectExpr("*", *[f"CAST(TransactionID % {k} AS DOUBLE) AS V{k}" for k in range(3, 16)], "2.5D AS prev_amount")


def test_only_a_cards_columns_go_to_their_card(payments, monkeypatch):
    wide = materialise(with_more_columns(payments))
    train, test = wide.where("TransactionID % 5 > 0"), wide.where("TransactionID % 5 = 0")
    sent = []
    monkeypatch.setattr(G, "card_sequence", lambda df, *rest, f=G.card_sequence: sent.append(len(df.columns)) or f(df, *rest))
    fitted = G.fit_features(train)
    plain = G.feature_chain(test, fitted=fitted, training=False, history=train)
    whole = sent.pop()
    large = G.feature_chain(test, policy=LARGE, fitted=fitted, training=False, history=train)
    assert sent == [9] and whole > 25  # seven of these cards' columns, card_id, __past
    assert sorted(plain.columns) == sorted(large.columns) and frame(plain, "TransactionID").round(9).equals(frame(large, "TransactionID").round(9))


def test_prepared_sets_order_cards_once(payments, monkeypatch):
    wide = materialise(with_more_columns(payments))
    train, test = materialise(wide.where("TransactionID % 5 > 0")), materialise(wide.where("TransactionID % 5 = 0"))
    ordered_once = []
    monkeypatch.setattr(G, "card_sequence", lambda df, *rest, f=G.card_sequence: ordered_once.append(1) or f(df, *rest))
    large = M.prepare_sets(train, test, policy=LARGE)
    assert len(ordered_once) == 1
    alike = M.prepare_sets(train, test)
    assert len(ordered_once) == 3
    for k in (2, 3):
        totals = [frame(s[k].select("TransactionID", F.aggregate(P.vector_to_array("features"), F.lit(0.0), lambda a, x: a + F.abs(x)).alias("t")), "TransactionID") for s in (large, alike)]
        assert totals[0].round(6).equals(totals[1].round(6))
    # an id on both sides is a given row of each: their sequences are made apart
    M.prepare_sets(train, test.unionByName(train.limit(1)), policy=LARGE)
    assert len(ordered_once) == 5


def test_split_reads_a_join_once(payments):
    from ledgerlens.operators.split import stratified_split

    joined = payments.join(payments.select("TransactionID", F.col("V1").alias("id_01")), "TransactionID")
    for side in stratified_split(joined, "TransactionID", "isFraud"):
        assert plan(side).count("Join") == 1  # of the cuts alone
