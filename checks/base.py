"""Registry and helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources.event_views import load_view, with_views

SHIFT = "0.00000023"
QUERIES: dict = {}
ORACLE: dict = {}


def check(name: str, sql: str | None = None, views=("txn",), doubles=()):
    """Register a query; `sql` is the same result in DuckDB over the named views. Counts that
    may be null are named in `doubles`, so neither engine's null handling shows."""

    def wrap(build):
        QUERIES[name] = lambda spark, folder: tidy(build(spark, folder), doubles)
        if sql is not None:
            ORACLE[name] = with_views(views, sql) if views else sql
        return build

    return wrap


def tidy(df: DataFrame, doubles=()) -> DataFrame:
    """Whole numbers as bigint and fractions rounded to six digits, so both engines compare.

    Means of cent amounts often end in an exact half at the seventh digit; a small shift keeps
    such values off the rounding border, where the last bit of a sum would decide.
    """
    out = []
    for f in df.schema.fields:
        if f.name in doubles or isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            out.append(f"round(CAST(`{f.name}` AS DOUBLE) + {SHIFT}D, 6) + 0D AS `{f.name}`")
        elif isinstance(f.dataType, (T.IntegralType, T.BooleanType)):
            out.append(f"CAST(`{f.name}` AS BIGINT) AS `{f.name}`")
        else:
            out.append(f"`{f.name}`")
    return df.selectExpr(*out)


def R(sql: str, name: str) -> str:
    return f"round({sql} + CAST({SHIFT} AS DOUBLE), 6) + CAST(0 AS DOUBLE) AS {name}"


def B(sql: str, name: str) -> str:
    return f"CAST({sql} AS BIGINT) AS {name}"


def flag(condition: str, name: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS BIGINT) AS {name}"


def txn(spark, folder) -> DataFrame:
    return load_view(spark, folder, "txn")


def ident(spark, folder) -> DataFrame:
    return load_view(spark, folder, "ident")


def _instant(df: DataFrame) -> DataFrame:
    """`ts` as an instant, so windows start at the same second in every session time zone."""
    return df.withColumn("ts", F.timestamp_seconds(F.col("sec") + 1704067200))


def requests(spark, folder) -> DataFrame:
    return _instant(load_view(spark, folder, "request_log"))


def predictions(spark, folder) -> DataFrame:
    return _instant(load_view(spark, folder, "prediction_log"))


def raw(spark, folder) -> DataFrame:
    from ledgerlens.operators.joins import merge_identity

    return merge_identity(txn(spark, folder), ident(spark, folder))


# ---- DuckDB fragments ------------------------------------------------------------------------

AMT, DT = "TransactionAmt", "TransactionDT"


def dtext(col: str, token: str) -> str:
    return f"coalesce(CAST({col} AS VARCHAR), '{token}')"


CARD_ID = (
    "concat_ws('_', CAST(card1 AS VARCHAR), " + ", ".join(dtext(c, "nan") for c in ("card2", "card3", "card4", "card5", "card6")) + ")"
)
CARDED = f"c AS (SELECT *, {CARD_ID} AS card_id FROM txn)"
W_CARD = f"PARTITION BY card_id ORDER BY {DT}, TransactionID"
CARD_TEXTS = {
    "card1": "CAST(card1 AS VARCHAR)", "card2": dtext("card2", "-1.0"), "card3": dtext("card3", "-1.0"),
    "card4": dtext("card4", "-1"), "card5": dtext("card5", "-1.0"), "card6": dtext("card6", "-1"),
}
EMAIL = {c: f"lower(coalesce({c}, 'missing'))" for c in ("P_emaildomain", "R_emaildomain")}
UIDS = {
    "uid1": f"concat_ws('_', CAST(card1 AS VARCHAR), {dtext('addr1', 'nan')})",
    "uid2": f"concat_ws('_', CAST(card1 AS VARCHAR), {dtext('addr1', 'nan')}, {dtext('D1', 'nan')})",
    "uid3": f"concat_ws('_', {', '.join(CARD_TEXTS.values())})",
    "uid4": f"concat_ws('_', CAST(card1 AS VARCHAR), {EMAIL['P_emaildomain']})",
}
WITH_UIDS = "u AS (SELECT *, " + ", ".join(f"{sql} AS {n}" for n, sql in UIDS.items()) + " FROM txn)"
DOUBLE_SUFFIX = "('co.uk','gov.uk','ac.uk','co.jp','com.au','net.au')"


def digest_bucket(seed: int, buckets: int) -> str:
    return f"(CAST('0x' || substr(md5('{seed}:' || TransactionID), 1, 15) AS BIGINT) % {buckets})"


def host_parts(domain: str) -> dict[str, str]:
    """Name and suffix of a normalised host name."""
    p = f"string_split(lower(trim({domain})), '.')"
    tail = f"concat_ws('.', {p}[-2], {p}[-1])"
    none = f"{domain} IN ('', 'missing', 'nan')"
    name = (
        f"CASE WHEN {none} THEN 'missing' WHEN len({p}) = 1 THEN {p}[1] "
        f"WHEN {tail} IN {DOUBLE_SUFFIX} AND len({p}) >= 3 THEN {p}[-3] ELSE {p}[-2] END"
    )
    suffix = (
        f"CASE WHEN {none} OR len({p}) = 1 THEN 'missing' WHEN {tail} IN {DOUBLE_SUFFIX} THEN {tail} "
        f"WHEN {p}[-1] = '' THEN 'missing' ELSE {p}[-1] END"
    )
    vendor = (
        f"CASE {name} WHEN 'gmail' THEN 'google' WHEN 'yahoo' THEN 'yahoo' WHEN 'hotmail' THEN 'microsoft' "
        "WHEN 'outlook' THEN 'microsoft' WHEN 'live' THEN 'microsoft' WHEN 'msn' THEN 'microsoft' "
        "WHEN 'icloud' THEN 'apple' WHEN 'aol' THEN 'aol' ELSE 'other' END"
    )
    return {"name": name, "tld": suffix, "vendor": vendor}
