"""Transaction, identity and log tables derived from the `events` table.

The given tables hold no card payments; these views turn every event into one, with missing
values, bin edges, repeated amounts and odd e-mail hosts placed by arithmetic on the ids.
`dialect` is `spark` or `duckdb`: only the epoch expression differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_EPOCH = 1704067200  # 2024-01-01T00:00:00Z, the start of the events

_SECONDS = {
    # Counted from a zone-less start, so the session's time zone does not matter.
    "spark": "timestampdiff(SECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)",
    "duckdb": f"CAST(floor(epoch(ts)) AS BIGINT) - {_EPOCH}",
}

_TXN = """
SELECT 3000000 + event_id AS TransactionID,
       {DT} AS TransactionDT,
       CASE WHEN event_id % 13 = 0 THEN CAST(100 AS DOUBLE) WHEN event_id % 17 = 0 THEN CAST(50 AS DOUBLE)
            WHEN event_id % 97 = 0 THEN CAST(12000.5 AS DOUBLE) ELSE value END AS TransactionAmt,
       CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_type = 'click' THEN 'W' WHEN event_type = 'view' THEN 'C'
            WHEN event_type = 'purchase' THEN 'H' WHEN event_type = 'signup' THEN 'R' ELSE 'S' END AS ProductCD,
       1000 + user_id AS card1,
       CASE WHEN user_id % 7 = 0 THEN NULL ELSE CAST(100 + user_id % 9 AS DOUBLE) END AS card2,
       CASE WHEN user_id % 5 = 0 THEN CAST(185 AS DOUBLE) ELSE CAST(150 AS DOUBLE) END AS card3,
       CASE user_id % 5 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' WHEN 2 THEN 'discover' WHEN 3 THEN 'american express' END AS card4,
       CASE WHEN user_id % 11 = 0 THEN NULL ELSE CAST(100 + user_id % 4 AS DOUBLE) END AS card5,
       CASE WHEN user_id % 2 = 0 THEN 'credit' ELSE 'debit' END AS card6,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(300 + user_id % 20 AS DOUBLE) END AS addr1,
       CASE WHEN event_id % 18 = 0 THEN NULL ELSE CAST(87 AS DOUBLE) END AS addr2,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE CAST(event_id % 500 AS DOUBLE) END AS dist1,
       CASE WHEN event_id % 10 = 0 THEN CAST(event_id % 300 AS DOUBLE) END AS dist2,
       CASE user_id % 8 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'Yahoo.com' WHEN 2 THEN 'hotmail.com' WHEN 3 THEN 'anonymous.com'
            WHEN 4 THEN 'yahoo.co.uk' WHEN 5 THEN 'mail.aol.com' WHEN 6 THEN 'localhost' END AS P_emaildomain,
       CASE (user_id + event_id % 3) % 8 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com' WHEN 2 THEN 'hotmail.com' WHEN 3 THEN 'icloud.com'
            WHEN 4 THEN 'yahoo.co.uk' WHEN 5 THEN 'live.com' WHEN 6 THEN 'localhost' END AS R_emaildomain,
       CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 4 AS DOUBLE) END AS D1,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id % 3 AS DOUBLE) END AS V1,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 5 AS DOUBLE) END AS V2,
       CASE WHEN event_id % 12 = 0 THEN NULL ELSE value END AS V3,
       CAST(user_id % 3 AS DOUBLE) AS V12,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 11 AS DOUBLE) END AS V13,
       CASE WHEN event_id % 8 = 0 THEN CAST(event_id % 100 AS DOUBLE) END AS V138,
       CASE WHEN event_type = 'error' AND event_id % 6 = 0 THEN 1 ELSE 0 END AS isFraud,
       CASE WHEN event_type = 'error' AND event_id % 6 = 0
            THEN CAST(0.35 AS DOUBLE) + CAST(0.6 AS DOUBLE) * CAST(event_id * 7919 % 1009 AS DOUBLE) / CAST(1009 AS DOUBLE)
            ELSE CAST(0.7 AS DOUBLE) * CAST(event_id * 7919 % 1009 AS DOUBLE) / CAST(1009 AS DOUBLE) END AS score
FROM events"""

_IDENT = """
SELECT 3000000 + event_id AS TransactionID,
       CASE WHEN event_id % 12 = 0 THEN NULL ELSE CAST(-(event_id % 40) AS DOUBLE) END AS id_01,
       CAST(event_id % 1000 AS DOUBLE) AS id_02,
       CASE WHEN event_id % 16 = 0 THEN CAST(event_id % 9 AS DOUBLE) END AS id_03,
       CASE WHEN event_id % 8 = 0 THEN 'Found' ELSE 'NotFound' END AS id_12,
       CASE event_id % 3 WHEN 0 THEN 'New' WHEN 1 THEN 'Found' ELSE 'Unknown' END AS id_15,
       CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Windows 10' WHEN 2 THEN 'iOS 11.2.5' WHEN 3 THEN 'Mac OS X 10_13_3' ELSE 'Linux' END AS id_30,
       CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'chrome 63.0' WHEN 2 THEN 'mobile safari 11.0' WHEN 3 THEN 'Firefox 57.0' ELSE 'edge 16.0' END AS id_31,
       CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '1920x1080' WHEN 2 THEN '2208x1242' WHEN 3 THEN 'bad' ELSE '1366xq' END AS id_33,
       CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'match_status:2' ELSE 'match_status:-1' END AS id_34,
       CASE WHEN event_id % 8 = 0 THEN 'T' ELSE 'F' END AS id_36,
       CASE WHEN event_id % 20 = 0 THEN NULL WHEN event_id % 8 = 0 THEN 'mobile' ELSE 'desktop' END AS DeviceType,
       CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Windows' WHEN 2 THEN 'iOS Device' WHEN 3 THEN 'SAMSUNG SM-G892A Build/NRD90M' ELSE 'rv:57.0' END AS DeviceInfo
FROM events WHERE event_id % 4 = 0"""

_REQUEST_LOG = """
SELECT ts, {DT} AS sec,
       CASE WHEN event_id % 10 = 0 THEN 'GET' ELSE 'POST' END AS method,
       CASE WHEN event_id % 10 = 0 THEN '/health' ELSE '/predict' END AS endpoint,
       CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
       value / CAST(50 AS DOUBLE) AS latency_s,
       CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'ValueError' ELSE 'KeyError' END END AS error_type,
       1 + event_id % 700 AS batch_size
FROM events"""

_PREDICTION_LOG = """
SELECT ts, {DT} AS sec, event_id AS seq,
       CASE WHEN user_id % 3 = 0 THEN 'v2' ELSE 'v1' END AS model_version,
       3000000 + event_id AS TransactionID,
       CASE WHEN score > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS pred, score AS prob
FROM (SELECT *, CASE WHEN event_type = 'error' AND event_id % 6 = 0
            THEN CAST(0.35 AS DOUBLE) + CAST(0.6 AS DOUBLE) * CAST(event_id * 7919 % 1009 AS DOUBLE) / CAST(1009 AS DOUBLE)
            ELSE CAST(0.7 AS DOUBLE) * CAST(event_id * 7919 % 1009 AS DOUBLE) / CAST(1009 AS DOUBLE) END AS score
      FROM events) e"""


def _wide(prefix: str, first: int, last: int, pad: int, whole: bool) -> str:
    """Numeric columns with different values, signs and shares of nulls; a row in 31 has none of them."""
    out = []
    for i in range(first, last + 1):
        value = f"(event_id * {2 * i + 1} + user_id) % {5 + i % 13} - {i % 4}"
        value = f"CAST({value} AS DOUBLE)" if whole or i % 5 else f"CAST({value} AS DOUBLE) / CAST(8 AS DOUBLE)"
        out.append(f"CASE WHEN event_id % 31 = 0 OR (event_id + {i}) % {3 + i % 7} = 0 THEN NULL ELSE {value} END AS {prefix}{i:0{pad}d}")
    return ",\n       ".join(out)


# every numeric column of both tables, which the narrow views hold a few of
_TXN_WIDE = f"SELECT 3000000 + event_id AS TransactionID,\n       {_wide('V', 1, 339, 1, False)}\nFROM events"
_IDENT_WIDE = f"""SELECT 3000000 + event_id AS TransactionID,
       {_wide('id_', 1, 11, 2, False)},
       CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Found' ELSE 'NotFound' END AS id_12,
       CASE event_id % 4 WHEN 0 THEN 'New' WHEN 1 THEN 'Found' WHEN 2 THEN 'Unknown' END AS id_15,
       CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'match_status:2' WHEN 2 THEN 'match_status:' WHEN 3 THEN '1' WHEN 4 THEN 'match_status:0' ELSE 'match_status:-1' END AS id_34,
       CASE event_id % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' END AS id_36
FROM events"""

VIEWS = {
    "txn": _TXN, "ident": _IDENT, "request_log": _REQUEST_LOG, "prediction_log": _PREDICTION_LOG,
    "txn_wide": _TXN_WIDE, "ident_wide": _IDENT_WIDE,
}


def view_sql(name: str, dialect: str) -> str:
    return VIEWS[name].replace("{DT}", _SECONDS[dialect]).strip()


def with_views(names, body: str, dialect: str = "duckdb") -> str:
    """`body` below the named views as common table expressions."""
    ctes = ",\n".join(f"{n} AS ({view_sql(n, dialect)})" for n in names)
    return f"WITH {ctes},\n{body.strip()[5:]}" if body.strip().upper().startswith("WITH ") else f"WITH {ctes}\n{body}"


def load_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the views over `folder/events.parquet`."""
    text = view_sql(name, "spark").replace("FROM events", "FROM {events}")
    return spark.sql(text, events=spark.read.parquet(f"{folder}/events.parquet"))
