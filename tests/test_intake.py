import pytest
from pyspark.sql import types as T

from ledgerlens.operators import joins, setops, validate
from ledgerlens.session import scratch_path
from ledgerlens.sources import catalogue, readers, registry, sinks
from ledgerlens.sources.files import write_text
from conftest import rows

SCHEMA = T.StructType([
    T.StructField("TransactionID", T.LongType()), T.StructField("TransactionAmt", T.DoubleType()),
    T.StructField("ProductCD", T.StringType()), T.StructField("isFraud", T.IntegerType()),
])


def test_compare_schema():
    other = T.StructType([
        T.StructField("TransactionID", T.IntegerType()), T.StructField("TransactionAmt", T.StringType()), T.StructField("more", T.LongType()),
    ])
    got = catalogue.compare_schema(other, SCHEMA)
    assert not got["match"] and got["missing_columns"] == ["ProductCD", "isFraud"] and got["extra_columns"] == ["more"]
    assert list(got["dtype_mismatches"]) == ["TransactionAmt"]
    with pytest.raises(catalogue.SchemaMismatchError):
        catalogue.compare_schema(other, SCHEMA, strict=True)
    assert catalogue.compare_schema(SCHEMA, SCHEMA)["match"]


def test_catalogue(spark):
    root = scratch_path(spark, "cat")
    with pytest.raises(catalogue.SchemaNotFoundError):
        catalogue.load_schema(spark, root, "raw_data")
    catalogue.save_schema(spark, SCHEMA, root, "raw_data")
    catalogue.save_schema(spark, SCHEMA, root, "raw_data")
    assert catalogue.load_schema(spark, root, "raw_data") == SCHEMA


def test_headers(spark):
    df = spark.createDataFrame([(1, 2.0, "W", "x")], "transactionid int, TRANSACTIONAMT double, ` productcd ` string, v1 string")
    assert validate.canonical_headers(df, SCHEMA.names).schema.names == ["TransactionID", "TransactionAmt", "ProductCD", "v1"]
    assert validate.normalise_headers(df.toDF("id-01", "b", "c", "d")).schema.names[0] == "id_01"
    with pytest.raises(validate.ValidationError):
        validate.canonical_headers(df.toDF("transactionid", "TransactionID", "a", "b"), SCHEMA.names)


def test_align(spark):
    df = spark.createDataFrame([(1, 9)], "TransactionID bigint, more int")
    assert validate.align_columns(df, SCHEMA, "isFraud").schema.names == ["TransactionID", "TransactionAmt", "ProductCD"]
    assert validate.align_columns(df, SCHEMA, "isFraud", keep_extra=True).schema.names[-1] == "more"


def test_bad_values_reject_or_quarantine(spark):
    df = spark.createDataFrame([("1", "garbage", "W"), ("2", "50.0", None), ("3.5", None, "C")], "TransactionID string, TransactionAmt string, ProductCD string")
    with pytest.raises(validate.ValidationError):
        validate.validate_rows(df, SCHEMA, "reject")
    good, bad = validate.validate_rows(df, SCHEMA)
    assert [r["TransactionID"] for r in rows(good, "TransactionID")] == [2]
    assert sorted(e.field for r in bad.collect() for e in r.row_errors) == ["TransactionAmt", "TransactionID"]


def test_null_tokens(spark):
    df = spark.createDataFrame([(" NaN ",), ("null",), ("",), ("ok",), (None,)], "s string")
    assert [r[0] for r in validate.clean_null_tokens(df).collect()] == [None, None, None, "ok", None]
    numbers = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in validate.nan_to_null(numbers).collect()] == [None, 1.0]


def test_ids(spark):
    none = spark.createDataFrame([(None, "b"), (None, "a")], "TransactionID bigint, k string")
    assert [(r["k"], r["TransactionID"]) for r in rows(validate.ensure_ids(none, order=["k"]), "k")] == [("a", 1), ("b", 2)]
    some = spark.createDataFrame([(None, "b"), (4, "a")], "TransactionID bigint, k string")
    with pytest.raises(validate.ValidationError):
        validate.ensure_ids(some)


def test_guards(spark):
    with pytest.raises(validate.EmptyBatchError):
        validate.require_rows(spark.range(0))
    with pytest.raises(validate.MissingModelError):
        validate.require_model(None)


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 300, 1 << 40, 1.5), (100, -5, 0, None)], "a bigint, b bigint, c bigint, d double")
    kinds = [f.dataType.simpleString() for f in validate.narrow_types(df).schema.fields]
    assert kinds == ["tinyint", "smallint", "bigint", "float"]


@pytest.mark.parametrize("sep,expected", [("\t", "\t"), (",", ","), (";", ";"), ("|", "|"), (" ", None)])
def test_delimited(spark, sep, expected):
    header = sep.join(["TransactionID", "'ProductCD'", "amt"])
    assert readers.sniff_delimiter(header) == expected
    path = scratch_path(spark, "text") + ".txt"
    write_text(spark, path, "\r\n".join([header, sep.join(["1", '"W"', "2.5"]), "", "lonely", sep.join(["2", "C", "-20"])]) + "\n")
    assert [tuple(r.values()) for r in rows(readers.read_delimited(spark, path), "TransactionID")] == [(1.0, "W", 2.5), (2.0, "C", -20.0)]


def test_reader_options(spark):
    assert readers.object_store_uri("b/", "/k/x.csv") == "s3a://b/k/x.csv"
    with pytest.raises(readers.UnsupportedFormatError):
        readers.read_table(spark, "/nowhere", "excel")
    with pytest.raises(ValueError):
        readers.warehouse_options("p")
    assert readers.warehouse_options("p", dataset="d", table="t")["table"] == "p.d.t"
    with pytest.raises(ValueError):
        readers.relational_options(url="jdbc:x")
    with pytest.raises(ValueError):
        readers.relational_options(table="t")
    parallel = readers.relational_options(url="jdbc:x", table="t", partition_column="id", bounds=(0, 9), partitions=4)
    assert parallel["dbtable"] == '"public"."t"' and parallel["numPartitions"] == "4"
    docs = readers.document_options("db", "c", {"a": 1}, username="u", password="p")
    assert docs["connection.uri"].startswith("mongodb://u:p@") and "$match" in docs["aggregation.pipeline"]


def test_nrows(spark):
    df = spark.range(1000)
    assert readers.read_rows(df, 10, key="id").count() == 10 and readers.read_rows(df, None).count() == 1000
    share = readers.read_rows(df, 0.5, key="id")
    assert 400 < share.count() < 600
    assert share.exceptAll(readers.read_rows(df.repartition(5), 0.5, key="id")).count() == 0


def test_registry(spark):
    root = scratch_path(spark, "registry")
    assert registry.next_version(spark, root, "M") == 1
    for v in (1, 2, 10):
        write_text(spark, f"{root}/M_v{v}/x", "1")
    write_text(spark, f"{root}/Other_v99/x", "1")
    assert registry.versions(spark, root, "M") == [1, 2, 10] and registry.next_version(spark, root, "M") == 11
    assert registry.resolve(spark, root, "M") == 10 and registry.resolve(spark, root, "M", "v2") == 2
    with pytest.raises(registry.ModelNotFoundError):
        registry.resolve(spark, root, "M", 3)
    assert registry.outdated(spark, root, "M") == [f"{root}/M_v1", f"{root}/M_v2"]


def test_metric_rows(spark):
    nine = sinks.evaluation_summary({"roc_auc": 0.9}, {"roc_auc": 0.8, "accuracy": 0.7})
    assert len(nine) == 9 and nine["test_accuracy"] == 0.7
    assert sinks.metric_rows(spark, nine).count() == 9


def test_joins(spark, txn, ident):
    assert joins.merge_identity(txn, ident).count() == txn.count()
    with pytest.raises(joins.DuplicateKeyError):
        joins.merge_identity(txn, ident.union(ident), check_unique=True)
    assert setops.column_difference(txn.select("TransactionID", "card1"), ident.select("TransactionID", "id_12")) == {
        "only_first": ["card1"], "only_second": ["id_12"], "both": ["TransactionID"],
    }
