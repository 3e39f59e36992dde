"""One tiny frame per special rule."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.config import DEFAULT
from ledgerlens.functions import keys as K
from ledgerlens.functions import scalars as S
from ledgerlens.functions import text as X
from ledgerlens.operators import stats
from ledgerlens.plans import features as G
from conftest import rows

CARD = "TransactionID bigint, TransactionDT bigint, TransactionAmt double, card_id string"


def cards(spark, data):
    return spark.createDataFrame(data, CARD)


def test_first_row_of_a_card_ignores_the_card_before(spark):
    df = cards(spark, [(1, 100, 10.0, "a"), (2, 200, 30.0, "a"), (3, 100, 7.0, "b"), (4, 200, 9.0, "b")])
    out = rows(G.amount_history(df), "TransactionID")
    assert [r["rolling_median_amt"] for r in out] == [10.0, 10.0, 7.0, 7.0]
    assert [r["prev_amount"] for r in out] == [10.0, 10.0, 7.0, 7.0]


def test_lag_example(spark):
    df = cards(spark, [(1, 200, 100.0, "a"), (2, 100, 5.0, "a"), (3, 300, 800.0, "a")])
    out = rows(G.amount_history(df), "TransactionDT")
    assert [round(r["amount_jump_ratio"], 6) for r in out] == [round(5 / 6, 6), round(100 / 6, 6), round(800 / 101, 6)]
    assert [r["is_amount_spike"] for r in out] == [0, 1, 1]


def test_rolling_median_uses_five_rows_before(spark):
    df = cards(spark, [(i, i, float(i * i), "a") for i in range(8)])
    out = rows(G.amount_history(df), "TransactionID")
    assert out[7]["rolling_median_amt"] == 16.0  # of 4, 9, 16, 25, 36


@pytest.mark.parametrize("gap,count", [(3599, 2), (3600, 1), (3601, 1)])
def test_velocity_boundary(spark, gap, count):
    df = cards(spark, [(1, 0, 1.0, "a"), (2, gap, 1.0, "a")])
    out = rows(G.time_history(df), "TransactionID")
    assert [r["Transaction_cnt_1hr"] for r in out] == [1, count]
    assert [r["Transaction_time_gap"] for r in out] == [999999, gap]


def test_product_stays_missing_until_known(spark):
    df = spark.createDataFrame(
        [(1, 1, 1.0, "a", None), (2, 2, 1.0, "a", "W"), (3, 3, 1.0, "a", None), (4, 0, 1.0, "b", None)],
        CARD + ", ProductCD string",
    )
    assert [r["ProductCD_filled"] for r in rows(G.product_filled(df), "TransactionID")] == [None, "W", "W", None]


def test_five_sample_rows(spark):
    df = spark.createDataFrame(
        [
            (2987203, 89760, 445.0, 18268, 583.0), (2987240, 90193, 37.098, 13413, 103.0),
            (2987243, 90246, 37.098, 13413, 103.0), (2987245, 90295, 37.098, 13413, 103.0),
            (2987288, 90986, 155.521, 16578, 545.0),
        ],
        "TransactionID bigint, TransactionDT bigint, TransactionAmt double, card1 bigint, card2 double",
    )
    out = rows(G.time_features(G.transaction_amount_features(df)), "TransactionID")
    card = [r for r in out if r["card1"] == 13413]
    assert [r["Transaction_time_gap"] for r in card] == [999999, 53, 49]
    assert {r["TransactionAmt_decimal"] for r in card} == {97} and {r["TransactionAmt_cents"] for r in card} == {9}
    assert {r["amt_repeat_count"] for r in card} == {3}


def test_amount_edges(spark):
    values = [0.0, 50.0, 50.01, 10000.0, 10000.01, -1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    assert [r[0] for r in df.selectExpr(S.amount_bin("a", DEFAULT.amount_edges)).collect()] == [
        None, 0.0, 1.0, 6.0, 7.0, None, None,
    ]
    assert df.selectExpr(S.decimal_part("a"), S.cents("a"), S.is_round("a")).collect()[-1] == (0, 0, 0)
    assert spark.sql(f"SELECT {S.cents('0.29D')}").first()[0] == 28


def test_key_text(spark):
    df = spark.createDataFrame([(12345678.0, 150.0, None, 7)], "big double, small double, none double, whole bigint")
    out = df.selectExpr(K.composite_key(df, ["big", "small", "none", "whole"]), K.card_text(df, "none")).first()
    assert out[0] == "12345678.0_150.0_nan_7" and out[1] == "-1.0"


def test_null_tokens_before_and_after_the_rewrite(spark):
    df = spark.createDataFrame(
        [(1, 5, 1.0, 1000, None, 150.0, None, None, "debit", None, None, None, "W")],
        "TransactionID bigint, TransactionDT bigint, TransactionAmt double, card1 bigint, card2 double, card3 double,"
        " card4 string, card5 double, card6 string, addr1 double, addr2 double, D1 double, ProductCD string",
    )
    out = G.uid_features(G.email_scalars(G.card_features(df))).first()
    assert out["card_id"] == "1000_nan_150.0_nan_nan_debit"
    assert out["uid3"] == "1000_-1.0_150.0_-1_-1.0_debit"
    assert out["uid1"] == "1000_nan" and out["card1_addrs1"] == "1000-0.0" and out["card1_ProductCD"] == "1000_W"
    assert out["card_add_count"] is None and out["uid4"] == "1000_missing"


def test_email_example(spark):
    df = spark.createDataFrame(
        [(1, "gmail.com", "hotmail.com"), (2, "yahoo.co.uk", "gmail.com"), (3, None, "unknown.net"), (4, None, None)],
        "TransactionID bigint, P_emaildomain string, R_emaildomain string",
    )
    out = rows(G.email_features(df), "TransactionID")
    assert [r["P_email_vendor"] for r in out] == ["google", "yahoo", "other", "other"]
    assert [r["P_email_tld"] for r in out] == ["com", "co.uk", "missing", "missing"]
    assert [r["email_domain_match"] for r in out] == [0, 0, 0, 1]
    assert [r["email_presence"] for r in out] == ["both_present", "both_present", "only_R", "both_missing"]
    assert out[2]["P_emaildomain"] == "missing" and {r["P_domain_fraud_rate"] for r in out} == {0.0}


def test_host_parts(spark):
    hosts = ["a.b.co.uk", "co.uk", "localhost", "", "mail.aol.com", "x.y.z.org"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hosts)], "i int, h string")
    out = rows(G.host_columns(df, {"P": "h"}), "i")
    assert [(r["P_host_name"], r["P_host_suffix"]) for r in out] == [
        ("b", "co.uk"), ("co", "co.uk"), ("localhost", ""), ("missing", ""), ("aol", "com"), ("z", "org"),
    ]
    sub = df.selectExpr("i", f"{X.host_labels('h')} AS l", "h").selectExpr("i", "h", "l", f"{X.host_tail('l')} AS t")
    got = rows(sub.selectExpr("i", X.email_subdomain("h", "l", "t", DEFAULT.two_part_suffixes) + " AS s"), "i")
    assert [r["s"] for r in got] == ["a", "", "", "", "mail", "x.y"]


def test_screen_and_device(spark):
    df = spark.createDataFrame(
        [(1, None, None, None, None), (2, "1920x1080", "chrome 63.0", "Windows 10", "SAMSUNG SM-G892A Build/NRD90M"),
         (3, "1366xq", "", "Linux", " /x")],
        "TransactionID bigint, id_33 string, id_31 string, id_30 string, DeviceInfo string",
    )
    a, b, c = rows(G.device_features(df), "TransactionID")
    assert (a["Screen_width"], a["Screen_height"], a["Screen_area"], a["Screen_aspect_ratio"]) == (-1, -1, 1, -1.0)
    assert b["Screen_area"] == 1920 * 1080 and b["Device_brand"] == "SAMSUNG" and b["os_version"] == "10"
    assert c["Screen_width"] == 1366 and c["Screen_height"] == -1 and c["os_version"] == "unknown"
    assert a["browser"] == c["browser"] == "unknown" and c["Device_brand"] == "unknown" and a["DeviceInfo_length"] == 0


def test_status_number(spark):
    df = spark.createDataFrame([("match_status:2",), ("match_status:-1",), ("x",), ("a:b",), (None,)], "s string")
    assert [r[0] for r in df.selectExpr(X.status_number("s")).collect()] == [2, -1, -1, -1, -1]


def test_row_statistics_of_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, None, None), (2, None, None, None), (3, 1.0, 3.0, None)], "TransactionID int, V1 double, V2 double, V138 double")
    a, b, c = rows(G.v_features(df), "TransactionID")
    assert (a["v1_sum"], a["v1_std"], a["V_nan_count_all"]) == (1.0, None, 2)
    assert (b["v1_sum"], b["v1_mean"]) == (0.0, None) and b["V_nan_ratio"] == 1.0
    assert math.isclose(c["v1_std"], math.sqrt(2))


def test_single_row_group_has_no_deviation(spark, txn):
    df = spark.createDataFrame([(1, 5.0, "a", 1.0), (2, 7.0, "b", 2.0), (3, 9.0, "b", None)], "TransactionID int, TransactionAmt double, u string, D1 double")
    out = rows(stats.profile_features(df, stats.fit_profiles(df, ["u"], "TransactionAmt", "D1"), "TransactionAmt", uids=["u"]), "TransactionID")
    assert out[0]["u_TransactionAmt_std"] is None and out[0]["u_TransactionAmt_to_std"] is None
    assert [r["u_count"] for r in out] == [1, 2, 2] and out[1]["u_D1_mean"] == 2.0


def test_missing_key_is_no_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5.0)], "TransactionID int, addr1 double")
    out = rows(stats.group_lookup(df, ["addr1"], {"n": F.count(F.lit(1))}), "TransactionID")
    assert [r["n"] for r in out] == [None, None, 1]


def test_unseen_key_at_scoring(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "k string, TransactionAmt double")
    new = spark.createDataFrame([("a", 2.0), ("z", 2.0)], "k string, TransactionAmt double")
    fitted = stats.fit_profiles(train, ["k"], "TransactionAmt")
    out = rows(stats.profile_features(new, fitted, "TransactionAmt", frequency=["k"], amounts=["k"]), "k")
    assert [(r["k_freq"], r["k_TransactionAmt_mean"]) for r in out] == [(2, 2.0), (None, None)]


def test_fold_rates_leave_out_the_own_fold(spark):
    data = [(i, "a", int(i % 3 == 0)) for i in range(10)] + [(100, "b", 1)]
    df = spark.createDataFrame(data, "TransactionID bigint, d string, isFraud int")
    fold = F.col("TransactionID") % 2
    rates = stats.fit_target_rates(df, "d", "isFraud", fold)
    out = {r["TransactionID"]: r["r"] for r in stats.target_rate_feature(df, rates, "r", fold).collect()}
    odd = [y for i, d, y in data if d == "a" and i % 2 == 1]
    assert out[0] == pytest.approx(sum(odd) / len(odd))
    assert out[100] == pytest.approx(sum(y for *_, y in data) / len(data))  # only in its own fold
    full = {r["TransactionID"]: r["r"] for r in stats.target_rate_feature(df, rates, "r").collect()}
    assert full[100] == 1.0


def test_config():
    assert list(DEFAULT.amount_edges) == sorted(DEFAULT.amount_edges)
    assert "uid1" in DEFAULT.uid_cols and "card1" in DEFAULT.card_cols
    assert DEFAULT.v_blocks["v7"][-1] == "V137"
