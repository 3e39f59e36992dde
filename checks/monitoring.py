"""T rows: drift, counters, rates, latency quantiles and alert rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import sketches
from ledgerlens.session import scratch_path
from ledgerlens.sources import sinks
from ledgerlens.streaming import alerts, counters, drift, scoring, state

from .base import AMT, B, R, check, flag, predictions, requests, txn

ID = "TransactionID"
LAST = "w AS (SELECT * FROM prediction_log ORDER BY sec DESC, seq DESC LIMIT 1000)"
REF = "q AS (SELECT 1 - power(1 - (i - CAST(0.5 AS DOUBLE)) / 1000, 1 / CAST(28 AS DOUBLE)) AS prob FROM range(1, 1001) t(i))"
KS = """
v AS (SELECT prob AS v, 1 AS a, 0 AS b FROM q UNION ALL SELECT prob, 0, 1 FROM w),
g AS (SELECT v, sum(a) AS a, sum(b) AS b FROM v GROUP BY v),
k AS (SELECT abs(sum(a) OVER (ORDER BY v) / CAST((SELECT sum(a) FROM g) AS DOUBLE) - sum(b) OVER (ORDER BY v) / CAST((SELECT sum(b) FROM g) AS DOUBLE)) AS gap FROM g)"""
LOG = ("prediction_log",)
REQ = ("request_log",)


@check("t1_prediction_window", f"WITH {LAST} SELECT seq, {R('prob', 'prob')} FROM w", LOG)
def prediction_window(s, d):
    return drift.recent_rows(predictions(s, d)).select("seq", "prob")


@check(
    "t1_prediction_window_stream",
    f"SELECT model_version, seq, {R('prob', 'prob')} FROM (SELECT *, row_number() OVER (PARTITION BY model_version ORDER BY sec DESC, seq DESC) AS k FROM prediction_log) WHERE k <= 1000",
    LOG,
)
def prediction_window_stream(s, d):
    """The log arrives in four files; the window kept by the stream equals the batch window."""
    inbox, state, ck = (scratch_path(s, f"window-{n}") for n in ("in", "state", "ck"))
    log = predictions(s, d).select("sec", "seq", "model_version", "prob")
    log.repartitionByRange(4, "seq").write.parquet(inbox)
    stream = s.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    drift.watch_predictions(stream, state, ck, available_now=True).awaitTermination()
    return drift._latest_state(s, state, 1 << 31).select("model_version", "seq", "prob")


@check(
    "t1_prediction_window_state",
    f"SELECT model_version, seq, {R('prob', 'prob')} FROM (SELECT *, row_number() OVER (PARTITION BY model_version ORDER BY sec DESC, seq DESC) AS k "
    "FROM (SELECT * REPLACE (CASE WHEN seq % 5 = 0 THEN NULL ELSE model_version END AS model_version) FROM prediction_log)) WHERE k <= 1000",
    LOG,
)
def prediction_window_state(s, d):
    """The window in keyed state, rows without a model included; the query is stopped and started again between the two halves of the log."""
    inbox, ck = (scratch_path(s, f"window-{n}") for n in ("in", "ck"))
    log = predictions(s, d).selectExpr("sec", "seq", "IF(seq % 5 = 0, NULL, model_version) AS model_version", "prob")
    for half in ("seq % 2 = 0", "seq % 2 = 1"):
        log.where(half).repartitionByRange(2, "seq").write.mode("append").parquet(inbox)
        stream = s.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        state.keep_recent(stream, ck, available_now=True).awaitTermination()
    return state.kept_rows(s, ck).select("model_version", "seq", "prob")


@check("t2_prediction_drift", f"WITH {LAST}, {REF}, {KS} SELECT {R('max(gap)', 'ks')}, {flag('max(gap) > 0.3', 'alert')} FROM k", LOG)
def prediction_drift(s, d):
    window = drift.recent_rows(predictions(s, d))
    ks = drift.ks_distance(drift.reference_sample(s), window, "prob")
    return ks.selectExpr("ks", f"CAST(ks > {drift.KS_LIMIT}D AS INT) AS alert")


LABEL = "abs(avg(CASE WHEN prob > 0.5 THEN 1 ELSE 0 END) - CAST(0.035 AS DOUBLE))"


@check("t3_label_drift", f"WITH {LAST} SELECT {R(LABEL, 'label_drift')}, count(*) AS samples_in_window FROM w", LOG)
def label_drift(s, d):
    return drift.label_drift(drift.recent_rows(predictions(s, d)))


@check(
    "t4_drift_report",
    f"WITH {LAST}, {REF}, {KS}, l AS (SELECT {LABEL} AS x, count(*) AS n FROM w), m AS (SELECT max(gap) AS ks FROM k) "
    f"SELECT {R('ks', 'prediction_drift')}, {flag('ks > 0.3', 'prediction_drift_alert')}, {R('x', 'label_drift')}, {flag('x > 0.05', 'label_drift_alert')}, n AS samples_in_window, {flag('n % 100 = 0', 'check_due')} FROM l, m",
    LOG,
)
def drift_report(s, d):
    return drift.drift_report(drift.recent_rows(predictions(s, d)), drift.reference_sample(s))


COUNT_SQL = "SELECT method, endpoint, CAST(status AS BIGINT) AS status, count(*) AS count FROM request_log GROUP BY 1, 2, 3"
_LABELS = counters.LABELS["inference_requests_total"]
check("t5_request_counters", COUNT_SQL, REQ)(lambda s, d: counters.counter(requests(s, d), _LABELS))
check("t5_error_counters", "SELECT error_type, count(*) AS count FROM request_log WHERE error_type IS NOT NULL GROUP BY 1", REQ)(
    lambda s, d: counters.counter(requests(s, d), counters.LABELS["inference_errors_total"])
)
check("t5_prediction_counters", "SELECT CASE WHEN pred = 1 THEN 'fraud' ELSE 'legitimate' END AS result, count(*) AS count FROM prediction_log GROUP BY 1", LOG)(
    lambda s, d: counters.counter(counters.prediction_results(predictions(s, d)), counters.LABELS["model_predictions_total"])
)


@check("t5_request_counters_stream", COUNT_SQL, REQ)
def request_counters_stream(s, d):
    inbox, out, ck = (scratch_path(s, f"counter-{n}") for n in ("in", "out", "ck"))
    log = requests(s, d).select(*_LABELS)
    log.repartition(3).write.parquet(inbox)
    stream = s.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    counters.keep_counter(stream, _LABELS, out, ck, available_now=True).awaitTermination()
    last = max(int(n.split("=")[1]) for n in drift.list_names(s, out) if n.startswith("batch="))
    return s.read.parquet(f"{out}/batch={last}")


EDGES = (0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0)
_counts = ", ".join(f"sum(CASE WHEN latency_s <= {e} THEN 1 ELSE 0 END) AS c{i}" for i, e in enumerate(EDGES))
_steps = " ".join(
    f"WHEN c{i} >= rank THEN {(EDGES[i - 1] if i else 0)} + {e - (EDGES[i - 1] if i else 0)} * (rank - {f'c{i - 1}' if i else 0}) / CAST(c{i} - {f'c{i - 1}' if i else 0} AS DOUBLE)"
    for i, e in enumerate(EDGES)
)


@check(
    "t6_latency_p99",
    f"WITH h AS (SELECT sec // 300 * 300 + 1704067200 AS window_start, count(*) AS requests, {_counts} FROM request_log GROUP BY 1), "
    f"k AS (SELECT *, CAST(0.99 AS DOUBLE) * requests AS rank FROM h), v AS (SELECT window_start, requests, CASE {_steps} ELSE 10 END AS x FROM k) "
    f"SELECT window_start, requests, {R('x', 'quantile')}, {flag('x > 2', 'alert')} FROM v",
    REQ,
)
def latency_p99(s, d):
    return alerts.latency_quantile(requests(s, d))


@check(
    "t6_latency_sketches",
    "WITH w AS (SELECT floor((sec // 60 * 60) / 300) * 300 - 300 * k AS window_start, sec // 60 * 60 AS slot, latency_s FROM request_log, range(0, 3) t(k)) "
    "SELECT CAST(window_start AS BIGINT) AS window_start, count(*) AS rows, CAST(1 AS BIGINT) AS within_bound FROM w WHERE window_start + 900 > slot GROUP BY 1",
    REQ,
)
def latency_sketches(s, d):
    """p99 over 15 minutes every 5, merged from stored sketches of single minutes; its rank among the window's own values is within the bound."""
    log = requests(s, d).select("sec", "latency_s")
    path = scratch_path(s, "minutes")
    sketches.quantile_sketches(log, "latency_s", "sec").write.parquet(path)
    found = sketches.window_quantiles(s.read.parquet(path), 0.99, 900, 300)
    spread = log.selectExpr("explode(sequence(sec DIV 300 * 300 - 600, sec DIV 300 * 300, 300)) AS window_start", "latency_s")
    ranked = spread.join(found, "window_start").groupBy("window_start", "rows").agg(
        F.count("*").alias("n"), F.count_if(F.col("latency_s") < F.col("quantile")).alias("below"), F.count_if(F.col("latency_s") <= F.col("quantile")).alias("upto")
    )
    low, high = 0.99 - sketches.RANK_ERROR, 0.99 + sketches.RANK_ERROR
    return ranked.selectExpr("window_start", "rows", f"CAST(n = rows AND below <= {high}D * n AND upto >= {low}D * n AS INT) AS within_bound")


@check(
    "t7_sliding_request_rate",
    f"WITH e AS (SELECT endpoint, sec // 60 * 60 - 60 * k + 1704067200 AS window_start FROM request_log, range(0, 5) t(k)) "
    f"SELECT endpoint, window_start, count(*) AS events, {R('count(*) / CAST(300 AS DOUBLE)', 'per_second')} FROM e GROUP BY 1, 2",
    REQ,
)
def sliding_rate(s, d):
    return alerts.sliding_rate(requests(s, d), ["endpoint"])


@check(
    "t7_counter_increase",
    f"SELECT seq, CASE WHEN p IS NULL THEN NULL ELSE {R('CASE WHEN v < p THEN v ELSE v - p END', 'increase')[: -len(' AS increase')]} END AS increase FROM "
    "(SELECT seq, v, lag(v) OVER (PARTITION BY model_version ORDER BY sec, seq) AS p FROM (SELECT *, seq % 500 AS v FROM prediction_log))",
    LOG, ("increase",),
)
def counter_increase(s, d):
    series = predictions(s, d).selectExpr("seq", "sec", "model_version", "seq % 500 AS value")
    return alerts.counter_increase(series, "model_version", ("sec", "seq")).select("seq", "increase")


@check(
    "t8_error_rate",
    f"WITH h AS (SELECT sec // 300 * 300 + 1704067200 AS window_start, count(*) AS requests, {B('sum(CASE WHEN status >= 500 THEN 1 ELSE 0 END)', 'errors')} FROM request_log GROUP BY 1) "
    f"SELECT *, {R('errors / CAST(requests AS DOUBLE)', 'error_rate')}, {flag('errors / CAST(requests AS DOUBLE) > 0.05', 'alert')} FROM h",
    REQ,
)
def error_rate(s, d):
    return alerts.error_rate(requests(s, d))


GAUGES = (
    "g AS (SELECT sec // 3600 * 3600 AS sec, 100 * avg(pred) AS fraud, avg(CASE WHEN pred = 1 THEN prob ELSE 1 - prob END) AS conf FROM prediction_log GROUP BY 1), "
    "s AS (SELECT sec, 'fraud_rate_percent' AS series, fraud AS value FROM g UNION ALL SELECT sec, 'model_confidence_score', conf FROM g)"
)


@check(
    "t9_quality_alerts",
    f"WITH {GAUGES} SELECT sec, series, {R('value', 'value')}, {flag(chr(40) + 'series = ' + chr(39) + 'fraud_rate_percent' + chr(39) + ' AND abs(value - 3.5) > 5) OR (series <> ' + chr(39) + 'fraud_rate_percent' + chr(39) + ' AND value < 0.7)', 'breach')} FROM s",
    LOG,
)
def quality_alerts(s, d):
    series = alerts.quality_series(predictions(s, d))
    parts = [
        alerts.apply_rule(series.where(F.col("series") == r.metric), r)
        for r in (alerts.RULES_BY_NAME["AbnormalFraudRate"], alerts.RULES_BY_NAME["LowModelConfidence"])
    ]
    return parts[0].unionByName(parts[1]).select("sec", "series", "value", "breach")


def islands(condition, hold):
    return (
        f"f AS (SELECT *, CASE WHEN {condition} THEN 1 ELSE 0 END AS breach FROM s), "
        "i AS (SELECT *, sum(1 - breach) OVER (PARTITION BY series ORDER BY sec ROWS UNBOUNDED PRECEDING) AS run FROM f) "
        "SELECT series, sec, CAST(breach AS BIGINT) AS breach, CAST(CASE WHEN breach = 1 AND sec - min(CASE WHEN breach = 1 THEN sec END) "
        f"OVER (PARTITION BY series, run) >= {hold} THEN 1 ELSE 0 END AS BIGINT) AS firing FROM i"
    )


RULE_SERIES = (
    f"WITH {GAUGES[:-1].replace('s AS (', 's0 AS (', 1)}), s AS (SELECT * FROM s0 UNION ALL SELECT DISTINCT sec, m.name, m.base + (sec // 3600) % 7 * m.step FROM g CROSS JOIN "
    "(VALUES ('cpu_used_percent', 60, 5), ('memory_used_percent', 70, 4), ('disk_free_percent', 4, 2), ('latency_p99', 1, 0.3), ('error_rate', 0.02, 0.01), "
    "('up', 0, 1), ('training_status', 0, 1), ('model_auc_roc', 0.8, 0.02)) AS m(name, base, step))"
)
@check("t10_sustained_condition", f"WITH {GAUGES}, {islands('value > 0.72', 7200)}", LOG)
def sustained(s, d):
    series = alerts.quality_series(predictions(s, d))
    return alerts.sustained(series, "series", "value > 0.72", 7200).select("series", "sec", "breach", "firing")


NODE_SQL = (
    "n AS (SELECT sec // 300 * 300 AS sec, concat('node', seq % 4) AS node, max(prob) * 100 AS cpu, 40 + 55 * avg(prob) AS mem, 60 * min(prob) AS disk FROM prediction_log GROUP BY 1, 2)"
)


@check(
    "t11_resource_alerts",
    f"WITH {NODE_SQL}, s AS (SELECT concat(node, ':cpu') AS series, sec, CASE WHEN cpu > 80 THEN 1 ELSE 0 END AS hit FROM n UNION ALL SELECT concat(node, ':memory'), sec, CASE WHEN mem > 85 THEN 1 ELSE 0 END FROM n "
    f"UNION ALL SELECT concat(node, ':disk'), sec, CASE WHEN disk < 10 THEN 1 ELSE 0 END FROM n), {islands('hit = 1', 300)}",
    LOG,
)
def resource_alerts(s, d):
    nodes = predictions(s, d).groupBy(F.expr("sec DIV 300 * 300").alias("sec"), F.expr("concat('node', seq % 4)").alias("node")).agg(
        (F.max("prob") * 100).alias("cpu"), (40 + 55 * F.avg("prob")).alias("mem"), (60 * F.min("prob")).alias("disk")
    )
    out = None
    for col, suffix, rule in (("cpu", "cpu", "HighCPUUsage"), ("mem", "memory", "HighMemoryUsage"), ("disk", "disk", "DiskSpaceLow")):
        series = nodes.selectExpr(f"concat(node, ':{suffix}') AS series", "sec", f"{col} AS value")
        part = alerts.apply_rule(series, alerts.RULES_BY_NAME[rule]).select("series", "sec", "breach", "firing")
        out = part if out is None else out.unionByName(part)
    return out


SCORE_RULE = "least(1.0D, TransactionAmt / 1000D)"


@check(
    "t12_streaming_scoring",
    f"SELECT {ID}, {flag(f'{AMT} / 1000 > 0.5', 'prediction_isFraud')} FROM txn WHERE {ID} % 50 <> 0",
)
def streaming_scoring(s, d):
    """Files with odd header spelling and unreadable amounts are validated and scored in batches."""
    from pyspark.sql import types as T

    inbox, out, ck = (scratch_path(s, f"scoring-{n}") for n in ("in", "out", "ck"))
    raw = txn(s, d).selectExpr(
        f"CAST({ID} AS STRING) AS transactionid", f"IF({ID} % 50 = 0, 'garbage', CAST({AMT} AS STRING)) AS TRANSACTIONAMT", "ProductCD AS productcd"
    )
    raw.repartition(3).write.parquet(inbox)
    expected = T.StructType([T.StructField(ID, T.LongType()), T.StructField(AMT, T.DoubleType()), T.StructField("ProductCD", T.StringType())])
    stream = scoring.arriving_rows(s, inbox, raw.schema, files_per_batch=1)
    score = lambda good: good.selectExpr(ID, f"CAST({SCORE_RULE} > 0.5D AS INT) AS prediction_isFraud")
    scoring.score_stream(stream, expected, score, out, ck, available_now=True).awaitTermination()
    return s.read.parquet(f"{out}/predictions").select(ID, "prediction_isFraud")


@check("t13_training_run_row", f"SELECT 'training_data_rows' AS name, {R('CAST(count(*) AS DOUBLE)', 'value')} FROM txn UNION ALL SELECT 'training_status', {R(1, 'value')}")
def training_run(s, d):
    path = scratch_path(s, "training")
    rows = sinks.training_run_rows(s, 1.5, 1, txn(s, d).count(), {"accuracy": 0.9})
    sinks.append_metrics(rows, path)
    return s.read.parquet(path).where("name IN ('training_data_rows', 'training_status')").select("name", "value")


_RULES = [(r.metric, r.condition, r.hold_seconds) for r in alerts.RULES]


@check(
    "t9_all_rules",
    f"{RULE_SERIES}, f AS (SELECT *, CASE " + " ".join(f"WHEN series = '{m}' AND {c} THEN 1" for m, c, _ in _RULES) + " ELSE 0 END AS breach, CASE "
    + " ".join(f"WHEN series = '{m}' THEN {h}" for m, _, h in _RULES) + " END AS hold FROM s), "
    "i AS (SELECT *, sum(1 - breach) OVER (PARTITION BY series ORDER BY sec ROWS UNBOUNDED PRECEDING) AS run FROM f) "
    "SELECT series, sec, CAST(breach AS BIGINT) AS breach, CAST(CASE WHEN breach = 1 AND sec - min(CASE WHEN breach = 1 THEN sec END) "
    "OVER (PARTITION BY series, run) >= hold THEN 1 ELSE 0 END AS BIGINT) AS firing FROM i",
    LOG,
)
def all_rules(s, d):
    """Every rule on its own series; gauges that the log has no data for follow the hour."""
    gauges = alerts.quality_series(predictions(s, d))
    made = {
        "cpu_used_percent": (60, 5), "memory_used_percent": (70, 4), "disk_free_percent": (4, 2), "latency_p99": (1, 0.3), "error_rate": (0.02, 0.01),
        "up": (0, 1), "training_status": (0, 1), "model_auc_roc": (0.8, 0.02),
    }
    hours = gauges.select("sec").distinct()
    parts = ", ".join(f"struct('{n}' AS series, CAST({b} + (sec DIV 3600) % 7 * {step} AS DOUBLE) AS value)" for n, (b, step) in made.items())
    series = gauges.select("sec", "series", F.col("value").cast("double")).unionByName(hours.selectExpr("sec", f"inline(array({parts}))"))
    out = None
    for rule in alerts.RULES:
        part = alerts.apply_rule(series.where(F.col("series") == rule.metric), rule).select("series", "sec", "breach", "firing")
        out = part if out is None else out.unionByName(part)
    return out
