"""P rows: alignment, cleaning, validation; S rows: sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import metrics, validate
from ledgerlens.session import scratch_path
from ledgerlens.sources import catalogue, readers, registry, sinks

from .base import AMT, DT, B, R, check, digest_bucket, ident, predictions, txn

ID = "TransactionID"
KEPT = [ID, DT, AMT, "ProductCD", "card1", "card2", "card4", "addr1", "P_emaildomain", "isFraud"]
_DOUBLES = {AMT, "card2", "addr1", "score"}


def kept_sql(cols=KEPT, where=""):
    out = [R(c, c) if c in _DOUBLES else (B(c, c) if c == "isFraud" else c) for c in cols]
    return f"SELECT {', '.join(out)} FROM txn {where}"


def kept(s, d):
    return txn(s, d).select(*KEPT)


# ---- projections, alignment, validation ----------------------------------------------------------

@check("p1_features_and_target", f"SELECT {B('count(*)', 'rows')}, {B('sum(isFraud)', 'frauds')}, {B(10, 'feature_columns')} FROM txn")
def features_and_target(s, d):
    x, y = validate.split_target(txn(s, d).select(*KEPT, "score"))
    return y.agg(F.count(F.lit(1)).alias("rows"), F.sum("isFraud").alias("frauds")).withColumn(
        "feature_columns", F.lit(len(x.schema.names))
    )


@check("p2_columns_by_kind", f"SELECT {R('V1', 'V1')}, {R('V2', 'V2')}, {R('V3', 'V3')}, {R('V12', 'V12')}, {R('V13', 'V13')}, {R('V138', 'V138')} FROM txn")
def columns_by_kind(s, d):
    df = txn(s, d)
    return df.select(*validate.columns_by_kind(df)["v"])


EXPECTED = T.StructType([
    T.StructField(ID, T.LongType()), T.StructField(DT, T.LongType()), T.StructField(AMT, T.DoubleType()),
    T.StructField("ProductCD", T.StringType()), T.StructField("card1", T.LongType()), T.StructField("card2", T.StringType()),
    T.StructField("C1", T.DoubleType()), T.StructField("isFraud", T.IntegerType()),
])


@check(
    "p3_schema_comparison",
    f"WITH k AS (SELECT count({ID}) a, count({DT}) b, count({AMT}) c, count(ProductCD) d, count(card1) e, count(card2) f, count(addr1) g FROM txn) "
    "SELECT 'TransactionID' AS \"column\", 'ok' AS status, a AS known FROM k UNION ALL SELECT 'TransactionDT', 'ok', b FROM k "
    "UNION ALL SELECT 'TransactionAmt', 'ok', c FROM k UNION ALL SELECT 'ProductCD', 'ok', d FROM k UNION ALL SELECT 'card1', 'ok', e FROM k "
    "UNION ALL SELECT 'card2', 'mismatch', f FROM k UNION ALL SELECT 'C1', 'missing', 0 FROM k UNION ALL SELECT 'isFraud', 'missing', 0 FROM k "
    "UNION ALL SELECT 'addr1', 'extra', g FROM k",
)
def schema_comparison(s, d):
    return catalogue.schema_status(txn(s, d).select(ID, DT, AMT, "ProductCD", "card1", "card2", "addr1"), EXPECTED)


@check(
    "p4_type_families",
    f"SELECT 'integer' AS family, {B(3, 'columns')}, count(*) AS rows FROM txn UNION ALL SELECT 'fraction', 3, count(*) FROM txn UNION ALL SELECT 'text', 3, count(*) FROM txn",
)
def type_families(s, d):
    df = txn(s, d).select(ID, DT, "card1", AMT, "card2", "addr1", "ProductCD", "card4", "card6")
    families = [catalogue.type_family(f.dataType) for f in df.schema.fields]
    parts = ", ".join(f"struct('{f}' AS family, {families.count(f)} AS columns)" for f in sorted(set(families)))
    return df.agg(F.count(F.lit(1)).alias("rows")).selectExpr("rows", f"inline(array({parts}))")


@check("p5_aligned_columns", f"SELECT {ID}, {DT}, {R(AMT, AMT)}, ProductCD, card1, CAST(NULL AS DOUBLE) AS C1 FROM txn")
def aligned(s, d):
    wanted = T.StructType([f for f in EXPECTED.fields if f.name != "card2"])
    return validate.align_columns(txn(s, d), wanted, "isFraud")


@check("p6_canonical_headers", kept_sql())
def canonical_headers(s, d):
    shouted = kept(s, d).toDF(*[f" {c.upper()} " if i % 2 else c.lower() for i, c in enumerate(KEPT)])
    return validate.canonical_headers(shouted, KEPT)


@check(
    "p7_null_tokens",
    f"SELECT {ID}, CASE WHEN ProductCD = 'W' THEN NULL ELSE ProductCD END AS ProductCD, CASE WHEN card4 = 'visa' THEN NULL ELSE card4 END AS card4 FROM txn",
)
def null_tokens(s, d):
    dirty = txn(s, d).selectExpr(
        ID, "IF(ProductCD = 'W', ' NULL ', ProductCD) AS ProductCD", "CASE WHEN card4 = 'visa' THEN 'NaN' WHEN card4 IS NULL THEN '' ELSE card4 END AS card4"
    )
    return validate.clean_null_tokens(dirty)


def dirty_rows(s, d):
    """Typed columns as text, some of them unreadable."""
    return txn(s, d).selectExpr(
        ID, f"IF({ID} % 50 = 0, 'garbage', CAST({AMT} AS STRING)) AS {AMT}",
        f"IF({ID} % 70 = 0, '12.5', CAST(card1 AS STRING)) AS card1", "CAST(addr1 AS STRING) AS addr1",
    )


TYPED = T.StructType([
    T.StructField(ID, T.LongType()), T.StructField(AMT, T.DoubleType()), T.StructField("card1", T.LongType()),
    T.StructField("addr1", T.DoubleType()),
])


@check(
    "p8_row_errors",
    f"SELECT {ID}, '{AMT}' AS field, 'garbage' AS value, 'not a double' AS reason FROM txn WHERE {ID} % 50 = 0 "
    f"UNION ALL SELECT {ID}, 'card1', '12.5', 'not a bigint' FROM txn WHERE {ID} % 70 = 0",
)
def row_errors(s, d):
    _, bad = validate.validate_rows(dirty_rows(s, d), TYPED)
    return validate.error_rows(bad, ID)


@check(
    "p8_whole_doubles",
    f"SELECT {ID}, CASE WHEN {ID} % 3 = 1 THEN 1 ELSE 0 END AS faults, CASE {ID} % 3 WHEN 0 THEN 12 WHEN 2 THEN 10000000 END AS card1 FROM txn",
)
def whole_doubles(s, d):
    """Whole numbers that arrive as doubles: 12.0 and 1e7 are taken, 12.5 is not."""
    rows = txn(s, d).selectExpr(ID, f"CASE {ID} % 3 WHEN 0 THEN 12.0D WHEN 1 THEN 12.5D ELSE 1e7D END AS card1")
    typed = validate.typed_rows(rows, T.StructType([T.StructField(ID, T.LongType()), T.StructField("card1", T.LongType())]))
    return typed.selectExpr(ID, "size(row_errors) AS faults", "card1")


@check("p8_valid_rows", f"SELECT {ID}, {R(AMT, AMT)}, card1, {R('addr1', 'addr1')} FROM txn WHERE {ID} % 50 <> 0 AND {ID} % 70 <> 0")
def valid_rows(s, d):
    good, _ = validate.validate_rows(dirty_rows(s, d), TYPED)
    return good


@check(
    "p9_numeric_coercion",
    f"SELECT {ID}, {R(f'CASE WHEN {ID} % 50 <> 0 THEN {AMT} END', AMT)}, {R(f'CASE WHEN {ID} % 70 = 0 THEN 12.5 ELSE card1 END', 'card1')} FROM txn",
)
def coerced(s, d):
    return validate.coerce_numeric(dirty_rows(s, d), [AMT, "card1"]).select(ID, AMT, "card1")


@check("p10_sequential_ids", f"SELECT {ID} AS arrival, row_number() OVER (ORDER BY {ID}) AS new_id FROM txn")
def sequential_ids(s, d):
    rows = txn(s, d).selectExpr(f"{ID} AS arrival", "CAST(NULL AS BIGINT) AS new_id")
    return validate.ensure_ids(rows, "new_id", ["arrival"])


@check("p11_header_style", f"SELECT {ID}, {R('id_01', 'id_01')}, id_12 FROM ident", ("ident",))
def header_style(s, d):
    hyphens = ident(s, d).select(ID, "id_01", "id_12").toDF(ID, "id-01", "id-12")
    return validate.normalise_headers(hyphens)


@check("p12_guarded_batch", f"SELECT {ID}, {R(AMT, AMT)} FROM txn")
def guarded_batch(s, d):
    return validate.require_rows(txn(s, d).select(ID, AMT))


NUMBERS = [ID, DT, AMT, "card1", "isFraud"]


@check(
    "p13_value_ranges",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {R(f'CAST(min({c}) AS DOUBLE)', 'low')}, {R(f'CAST(max({c}) AS DOUBLE)', 'high')} FROM txn" for c in NUMBERS),
)
def value_ranges(s, d):
    return validate.value_ranges(txn(s, d).select(*NUMBERS))


@check("p13_narrowed_types", f"SELECT {ID}, {DT}, card1, {B('isFraud', 'isFraud')} FROM txn")
def narrowed(s, d):
    return validate.narrow_types(txn(s, d).select(ID, DT, "card1", "isFraud"))


def _smallest(c: str) -> str:
    fits = " ".join(f"WHEN min({c}) > {-(1 << (b - 1))} AND max({c}) < {(1 << (b - 1)) - 1} THEN '{t}'" for b, t in ((8, "tinyint"), (16, "smallint"), (32, "int")))
    return f"SELECT '{c}' AS \"column\", CASE {fits} ELSE 'bigint' END AS kind FROM txn"


@check("p13_types_by_column", " UNION ALL ".join(map(_smallest, (ID, DT, "card1", "isFraud"))) + f" UNION ALL SELECT '{AMT}', 'float' FROM (SELECT max({AMT}) AS m FROM txn) WHERE m < 1e38")
def types_by_column(s, d):
    narrow = validate.narrow_types(txn(s, d).select(ID, DT, "card1", "isFraud", AMT))
    return s.createDataFrame(narrow.dtypes, "column string, kind string")


@check("p15_preview", kept_sql(where=f"ORDER BY {ID} LIMIT 5"))
def preview(s, d):
    return readers.first_rows(kept(s, d), 5, ID)


# ---- sources and sinks -----------------------------------------------------------------------------

def _round_trip(kind):
    def build(s, d):
        df, path = kept(s, d), scratch_path(s, f"roundtrip-{kind}")
        sinks.write_table(df, path, kind)
        return readers.read_table(s, path, kind, df.schema).select(*KEPT)

    return build


check("s1_csv_scan", kept_sql())(_round_trip("csv"))
check("s4_parquet_scan", kept_sql())(_round_trip("parquet"))
check("s5_json_scan", kept_sql())(_round_trip("json"))
check("s2_first_rows", kept_sql(where=f"ORDER BY {ID} LIMIT 1000"))(lambda s, d: readers.read_rows(kept(s, d), 1000, key=ID))
check("s3_fraction_by_hash", kept_sql(where=f"WHERE {digest_bucket(6, 1000000)} < 500000"))(lambda s, d: readers.sample_rows(kept(s, d), 0.5, key=ID))
check("s3_fraction_bernoulli")(lambda s, d: readers.sample_rows(kept(s, d), 0.5))


@check("s10_delimited_text", kept_sql([ID, AMT, "card1", "ProductCD", "addr1"]))
def delimited(s, d):
    path = scratch_path(s, "delimited")
    line = F.concat_ws(";", ID, AMT, "card1", F.concat(F.lit('"'), F.coalesce("ProductCD", F.lit("")), F.lit('"')), F.coalesce(F.col("addr1").cast("string"), F.lit("")))
    rows = txn(s, d).select(line.alias("value"))
    # A header line starts every file, as exports in several parts have it.
    header = f"{ID};{AMT};card1;'ProductCD';addr1"

    def with_header(batches):
        import pandas as pd

        yield pd.DataFrame({"value": [header]})
        yield from batches

    rows.repartition(3).mapInPandas(with_header, "value string").write.text(path)
    out = readers.read_delimited(s, path)
    return out.select(F.col(ID).cast("bigint"), AMT, F.col("card1").cast("bigint"), "ProductCD", "addr1")


@check("s11_record_batches", f"SELECT {ID}, {R(AMT, AMT)}, CASE WHEN {ID} % 4 = 0 THEN NULL ELSE ProductCD END AS ProductCD FROM txn")
def record_batches(s, d):
    one = F.to_json(F.struct(ID, AMT, F.when(F.col(ID) % 4 != 0, F.col("ProductCD")).alias("ProductCD")))
    rows = txn(s, d).select(F.floor(F.col(ID) / 20).alias("batch"), one.alias("j"))
    # Requests hold at most 20 records each.
    batches = rows.groupBy("batch").agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]")).alias("body"))
    schema = T.StructType([T.StructField(ID, T.LongType()), T.StructField(AMT, T.DoubleType()), T.StructField("ProductCD", T.StringType())])
    return readers.records_to_table(batches, "body", schema)


@check("s12_table_sink_by_day", f"SELECT CAST({DT} // 86400 AS BIGINT) AS day, count(*) AS rows, {R(f'sum({AMT})', 'amount')} FROM txn GROUP BY 1")
def table_sink(s, d):
    path = scratch_path(s, "table")
    days = sinks.with_day(kept(s, d))
    # a day is shared out over tasks by a salt, so a busy day is not one task's work
    sinks.write_table(days.repartition("day", F.expr(f"pmod({ID}, 8)")), path, partition_by=["day"])
    return s.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.sum(AMT).alias("amount"))


@check("s13_prediction_export", f"SELECT {ID}, {B('pred', 'isFraud')} FROM prediction_log", ("prediction_log",))
def prediction_export(s, d):
    path = scratch_path(s, "export")
    sinks.export_predictions(predictions(s, d), path, pred="pred")
    return s.read.schema(f"{ID} bigint, isFraud int").csv(path, header=True)


@check("s14_schema_catalogue", kept_sql())
def schema_catalogue(s, d):
    root, df = scratch_path(s, "catalogue"), kept(s, d)
    catalogue.save_schema(s, df.schema, root, "raw_data")
    return validate.align_columns(txn(s, d), catalogue.load_schema(s, root, "raw_data"))


@check(
    "s15_metrics_sink",
    f"WITH p AS (SELECT isFraud, CASE WHEN score > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS pred FROM txn) "
    f"SELECT 'true_positives' AS name, {R('sum(isFraud * pred)', 'value')} FROM p UNION ALL SELECT 'false_positives', {R('sum((1 - isFraud) * pred)', 'value')} FROM p",
)
def metrics_sink(s, d):
    path = scratch_path(s, "metrics")
    row = metrics.confusion_counts(metrics.with_prediction(txn(s, d), "score"), "isFraud", "pred").first().asDict()
    sinks.append_metrics(sinks.metric_rows(s, {k: row[k] for k in ("true_positives", "false_positives")}), path)
    return s.read.parquet(path).select("name", "value")


@check("s16_versioned_names", f"SELECT event_type AS name, {B('max(event_id % 40) + 1', 'next_version')} FROM events GROUP BY event_type", ())
def versioned_names(s, d):
    from ledgerlens.functions.scalars import version_number

    listed = s.read.parquet(f"{d}/events.parquet").selectExpr("event_type AS name", "concat(event_type, '_v', event_id % 40) AS folder")
    return listed.groupBy("name").agg((F.expr(f"max({version_number('folder')})") + 1).alias("next_version"))


@check(
    "s16_pruned_versions",
    "SELECT 'FraudModel' AS name, 'dry run' AS step, CAST(4 AS BIGINT) AS listed, CAST(5 AS BIGINT) AS present UNION ALL SELECT 'FraudModel', 'pruned', 4, 1 "
    "FROM (SELECT count(*) AS n FROM events) WHERE n > 0", (),
)
def pruned_versions(s, d):
    """Five stored versions of the mean of the table: a dry run removes nothing, a real one keeps the newest."""
    root = scratch_path(s, "versions")
    df = s.read.parquet(f"{d}/events.parquet")
    rows = []
    for v in range(1, 6):
        df.agg(F.avg("value").alias("mean")).write.parquet(registry.version_path(root, "FraudModel", v))
    for step, dry in (("dry run", True), ("pruned", False)):
        listed = len(registry.prune(s, root, "FraudModel", dry_run=dry))
        rows.append(("FraudModel", step, listed, len(registry.versions(s, root, "FraudModel"))))
    return s.createDataFrame(rows, "name string, step string, listed long, present long")


@check("s17_registry_rows", f"SELECT 'FraudModel' AS name, {B(2, 'version')}, {R('avg(isFraud)', 'fraud_rate')} FROM txn")
def registry_rows(s, d):
    rate = txn(s, d).agg(F.avg("isFraud")).first()[0]
    rows = [registry.metadata_row(s, "FraudModel", v, {"fraud_rate": rate}, {"depth": 8}) for v in (1, 2)]
    latest = registry.latest_rows(rows[0].unionByName(rows[1]))
    return latest.select("name", "version", F.col("metrics")["fraud_rate"].alias("fraud_rate"))
