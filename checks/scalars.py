"""F rows: scalar expressions over the transaction and identity views."""

from __future__ import annotations

from ledgerlens.config import DEFAULT, NULL_TOKENS
from ledgerlens.functions import scalars as S
from ledgerlens.functions import text as X
from ledgerlens.operators.joins import map_lookup
from ledgerlens.plans import features as G

from .base import (
    AMT, CARD_TEXTS, CARDED, DT, EMAIL, UIDS, B, R, check, dtext, flag, host_parts, ident, txn,
)

ID = "TransactionID"

BIN_SQL = (
    "CASE WHEN a <= 0 THEN NULL WHEN a <= 50 THEN 0 WHEN a <= 100 THEN 1 WHEN a <= 200 THEN 2 WHEN a <= 500 THEN 3 "
    "WHEN a <= 1000 THEN 4 WHEN a <= 5000 THEN 5 WHEN a <= 10000 THEN 6 WHEN a > 10000 THEN 7 END"
)
HOUR = f"(({DT} // 3600) % 24)"
TOD = f"CASE WHEN {HOUR} <= 6 THEN 0 WHEN {HOUR} <= 12 THEN 1 WHEN {HOUR} <= 18 THEN 2 ELSE 3 END"


def _scalar(name, sql_cols, spark_cols, source=txn, views=("txn",), table="txn"):
    check(name, f"SELECT {ID}, {', '.join(sql_cols)} FROM {table}", views)(
        lambda s, d: source(s, d).selectExpr(ID, *spark_cols)
    )


_scalar(
    "f1_log_amount_and_distance",
    [R(f"ln(1 + {AMT})", "amt_log"), R("ln(1 + coalesce(dist1, 0))", "dist1_log"), R("ln(1 + coalesce(dist2, 0))", "dist2_log")],
    [f"{S.log_amount(AMT)} AS amt_log", f"{S.log_distance('dist1')} AS dist1_log", f"{S.log_distance('dist2')} AS dist2_log"],
)
_scalar("f2_decimal_part", [B(f"trunc(({AMT} - trunc({AMT})) * 1000)", "amt_decimal")], [f"{S.decimal_part(AMT)} AS amt_decimal"])
_scalar("f3_is_round", [flag(f"{AMT} = trunc({AMT})", "is_round")], [f"{S.is_round(AMT)} AS is_round"])
_scalar("f4_cents", [B(f"trunc(({AMT} * 100) % 100)", "cents")], [f"{S.cents(AMT)} AS cents"])
check("f5_amount_bins", f"SELECT {ID}, {R(f'CAST({BIN_SQL} AS DOUBLE)', 'amt_bin')} FROM (SELECT {ID}, CAST({AMT} AS FLOAT) AS a FROM txn)")(
    lambda s, d: txn(s, d).selectExpr(ID, f"{S.amount_bin(AMT, DEFAULT.amount_edges)} AS amt_bin")
)
_scalar(
    "f6_hour_and_second_of_day", [B(HOUR, "hour"), B(f"{DT} % 86400", "sec_in_day")],
    [f"{S.hour_of_day(DT)} AS hour", f"{S.second_of_day(DT)} AS sec_in_day"],
)
_scalar("f7_time_of_day", [B(TOD, "time_of_day")], [f"{S.time_of_day(S.hour_of_day(DT), DEFAULT.time_of_day_edges)} AS time_of_day"])
_scalar(
    "f8_night_and_business_hours", [flag(f"{HOUR} < 6", "is_night"), flag(f"{HOUR} BETWEEN 9 AND 17", "is_business")],
    [f"{S.is_night(S.hour_of_day(DT))} AS is_night", f"{S.is_business_hour(S.hour_of_day(DT))} AS is_business"],
)
_scalar(
    "f9_cyclic_hour", [R(f"sin(2 * pi() * {HOUR} / 24)", "hour_sin"), R(f"cos(2 * pi() * {HOUR} / 24)", "hour_cos")],
    [f"{S.hour_sine(S.hour_of_day(DT))} AS hour_sin", f"{S.hour_cosine(S.hour_of_day(DT))} AS hour_cos"],
)

CARD_KEYS_SQL = f"""
SELECT {ID}, card_id,
       concat({CARD_TEXTS['card1']}, '-', {dtext('addr1', '0.0')}) AS card1_addrs1,
       concat({CARD_TEXTS['card1']}, '-', {dtext('addr2', '0.0')}) AS card1_addrs2,
       concat({CARD_TEXTS['card2']}, '-', {dtext('addr1', '0.0')}) AS card2_addrs1,
       concat({CARD_TEXTS['card1']}, '_', coalesce(p, 'nan')) AS card1_ProductCD,
       concat({CARD_TEXTS['card2']}, '_', coalesce(p, 'nan')) AS card2_ProductCD,
       concat({dtext('addr1', 'nan')}, '_', {dtext('addr2', 'nan')}) AS addr1_addr2,
       concat({dtext('addr1', 'nan')}, '_', {dtext('ProductCD', 'nan')}) AS addr1_ProductCD
FROM (SELECT *, last_value(ProductCD IGNORE NULLS) OVER (PARTITION BY card_id ORDER BY {DT}, {ID}
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM c)"""


@check("f10_composite_keys", f"WITH {CARDED} {CARD_KEYS_SQL}")
def composite_keys(s, d):
    return G.address_features(G.card_keys(txn(s, d))).select(
        ID, "card_id", "card1_addrs1", "card1_addrs2", "card2_addrs1", "card1_ProductCD", "card2_ProductCD",
        "addr1_addr2", "addr1_ProductCD",
    )


@check("f11_uids", f"SELECT {ID}, " + ", ".join(f"{sql} AS {n}" for n, sql in UIDS.items()) + " FROM txn")
def uids(s, d):
    return G.uid_features(G.email_scalars(G.card_texts(txn(s, d)))).select(ID, *UIDS)


_scalar(
    "f12_email_normalised", [f"{sql} AS {c}" for c, sql in EMAIL.items()],
    [f"{X.normalise_email(c)} AS {c}" for c in EMAIL],
)

_p, _r = host_parts("p"), host_parts("r")
_hosts = f"(SELECT {ID}, {EMAIL['P_emaildomain']} AS p, {EMAIL['R_emaildomain']} AS r FROM txn)"


def _hosted(s, d):
    return txn(s, d).selectExpr(
        ID, f"{X.normalise_email('P_emaildomain')} AS p", f"{X.normalise_email('R_emaildomain')} AS r"
    )


def _parsed(s, d):
    return G.host_columns(_hosted(s, d), {"P": "p", "R": "r"})


check("f13_domain_parts", f"SELECT {ID}, {_p['name']} AS p_name, {_p['tld']} AS p_suffix, {_r['name']} AS r_name, {_r['tld']} AS r_suffix FROM {_hosts}")(
    lambda s, d: _parsed(s, d).selectExpr(
        ID, "P_host_name AS p_name", f"{X.email_tld('P_host_suffix')} AS p_suffix",
        "R_host_name AS r_name", f"{X.email_tld('R_host_suffix')} AS r_suffix",
    )
)
check("f14_email_vendor_and_tld", f"SELECT {ID}, {_p['vendor']} AS p_vendor, {_r['vendor']} AS r_vendor, {_p['tld']} AS p_tld, {_r['tld']} AS r_tld FROM {_hosts}")(
    lambda s, d: _parsed(s, d).selectExpr(
        ID, f"{X.email_vendor('P_host_name', DEFAULT.email_vendors)} AS p_vendor",
        f"{X.email_vendor('R_host_name', DEFAULT.email_vendors)} AS r_vendor",
        f"{X.email_tld('P_host_suffix')} AS p_tld", f"{X.email_tld('R_host_suffix')} AS r_tld",
    )
)
PRESENCE = (
    "CASE WHEN p <> 'missing' AND r <> 'missing' THEN 'both_present' WHEN p <> 'missing' THEN 'only_P' "
    "WHEN r <> 'missing' THEN 'only_R' ELSE 'both_missing' END"
)
check("f15_email_match_and_presence", f"SELECT {ID}, {flag('p = r', 'email_match')}, {PRESENCE} AS presence FROM {_hosts}")(
    lambda s, d: _hosted(s, d).selectExpr(ID, f"{S.flag('p = r')} AS email_match", f"{X.email_presence('p', 'r')} AS presence")
)

DEVICE = {
    "f16": [flag("DeviceType = 'mobile'", "DeviceType_is_mobile"), flag("DeviceType = 'desktop'", "DeviceType_is_desktop")],
    "f17": [
        "coalesce(nullif(regexp_split_to_array(trim(string_split(DeviceInfo, '/')[1]), '\\s+')[1], ''), 'unknown') AS Device_brand",
        B("coalesce(length(DeviceInfo), 0)", "DeviceInfo_length"),
    ],
    "f18": [
        "coalesce(nullif(lower(regexp_split_to_array(trim(id_31), '\\s+')[1]), ''), 'unknown') AS browser",
        *[flag(f"contains(lower(id_31), '{w}')", f"Broser_is_{w}") for w in ("chrome", "firefox", "edge", "safari")],
    ],
    "f19": [
        "coalesce(nullif(string_split(id_30, ' ')[1], ''), 'unknown') AS os_name",
        "coalesce(CASE WHEN contains(id_30, ' ') THEN nullif(substr(id_30, strpos(id_30, ' ') + 1), '') END, 'unknown') AS os_version",
        *[flag(f"contains(lower(id_30), '{w.lower()}')", f"OS_is_{w}") for w in ("Windows", "Mac", "iOS", "Android")],
    ],
}
SCREEN_INNER = (
    "SELECT *, CASE WHEN contains(id_33, 'x') THEN coalesce(try_cast(string_split(id_33, 'x')[1] AS INTEGER), -1) ELSE -1 END AS sw,"
    " CASE WHEN contains(id_33, 'x') THEN coalesce(try_cast(string_split(id_33, 'x')[2] AS INTEGER), -1) ELSE -1 END AS sh FROM {src}"
)
SCREEN = [
    B("sw", "Screen_width"), B("sh", "Screen_height"), B("CAST(sw AS BIGINT) * sh", "Screen_area"),
    R("CASE WHEN sh > 0 THEN CAST(sw AS DOUBLE) / sh ELSE -1 END", "Screen_aspect_ratio"),
]


def _device(name, cols):
    names = [c.rsplit(" AS ", 1)[1] for c in cols]
    check(name, f"SELECT {ID}, {', '.join(cols)} FROM ident", ("ident",))(
        lambda s, d: G.device_features(ident(s, d)).select(ID, *names)
    )


_device("f16_device_type_flags", DEVICE["f16"])
_device("f17_device_brand_and_length", DEVICE["f17"])
_device("f18_browser", DEVICE["f18"])
_device("f19_os_name_and_version", DEVICE["f19"])


@check("f20_screen", f"SELECT {ID}, {', '.join(SCREEN)} FROM ({SCREEN_INNER.format(src='ident')})", ("ident",))
def screen(s, d):
    return G.device_features(ident(s, d)).select(ID, "Screen_width", "Screen_height", "Screen_area", "Screen_aspect_ratio")


MISSING = [flag(f"{c} IS NULL", f"{c}_missing") for c in ("addr1", "addr2", "dist1", "dist2")] + [
    flag("addr1 IS NULL AND addr2 IS NULL", "both_addr_missing")
]


@check("f21_missing_flags", f"SELECT {ID}, {', '.join(MISSING)} FROM txn")
def missing(s, d):
    return G.address_features(txn(s, d)).select(
        ID, "addr1_missing", "addr2_missing", "dist1_missing", "dist2_missing", "both_addr_missing"
    )


STATUS = B("CASE WHEN contains(id_34, ':') THEN coalesce(try_cast(string_split(id_34, ':')[2] AS INTEGER), -1) ELSE -1 END", "id_34_match")
_scalar("f22_status_number", [STATUS], [f"{X.status_number('id_34')} AS id_34_match"], ident, ("ident",), "ident")

ID_FLAGS_SQL = [
    flag("id_12 = 'Found'", "id_12_isFound"), flag("id_15 = 'New'", "id_15_isNew"),
    flag("id_15 = 'Found'", "id_15_isFound"), flag("id_36 = 'T'", "id_36_isT"),
]


@check("f23_identity_flags", f"SELECT {ID}, {', '.join(ID_FLAGS_SQL)} FROM ident", ("ident",))
def identity_flags(s, d):
    return G.id_features(ident(s, d)).select(ID, "id_12_isFound", "id_15_isNew", "id_15_isFound", "id_36_isT")


_scalar(
    "f24_guarded_ratios", [R(f"{AMT} / nullif(coalesce(V2, -1) + 1, 0)", "ratio_one"), R(f"{AMT} / (V12 + 0.001)", "ratio_small")],
    [f"{S.ratio(AMT, 'coalesce(V2, -1)', 1.0)} AS ratio_one", f"{S.ratio(AMT, 'V12', 0.001)} AS ratio_small"],
)
check(
    "f25_version_number",
    f"SELECT event_id, {R('CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 40 AS DOUBLE) END', 'version')} FROM events", (), ("version",),
)(
    lambda s, d: s.read.parquet(f"{d}/events.parquet").selectExpr(
        "event_id", "concat(event_type, '_v', event_id % 40, IF(event_id % 3 = 0, 'x', '')) AS name"
    ).selectExpr("event_id", f"{S.version_number('name')} AS version")
)
_scalar(
    "f26_null_tokens_and_numbers",
    ["CASE WHEN ProductCD IN ('W', 'S') OR ProductCD IS NULL THEN NULL ELSE ProductCD END AS product",
     R(f"CASE WHEN {ID} % 10 = 0 THEN NULL ELSE {AMT} END", "amount")],
    [
        X.clean_null_token(
            "CASE WHEN ProductCD = 'W' THEN ' NaN ' WHEN ProductCD = 'S' THEN 'Null' ELSE ProductCD END", NULL_TOKENS
        ) + " AS product",
        S.to_number(f"CASE WHEN {ID} % 10 = 0 THEN 'garbage' ELSE CAST({AMT} AS STRING) END") + " AS amount",
    ],
)
check("j5_vendor_map", f"SELECT {ID}, {_p['vendor']} AS vendor FROM {_hosts}")(
    lambda s, d: _parsed(s, d).selectExpr(ID, f"{map_lookup('P_host_name', DEFAULT.email_vendors, 'other')} AS vendor")
)
_scalar(
    "p14_threshold_flags",
    [flag(f"{AMT} < 10", "is_micro"), flag(f"{AMT} = trunc({AMT})", "is_round"), flag(f"{HOUR} < 6", "is_night"), flag(f"{HOUR} BETWEEN 9 AND 17", "is_business")],
    [f"{S.flag(f'{AMT} < 10')} AS is_micro", f"{S.is_round(AMT)} AS is_round", f"{S.is_night(S.hour_of_day(DT))} AS is_night", f"{S.is_business_hour(S.hour_of_day(DT))} AS is_business"],
)
