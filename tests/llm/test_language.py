"""Language identification: held-out accuracy, rejection, odd rows."""

from pyspark.sql import functions as F

from ledgerlens.llm import language
from ledgerlens.llm.queries import op3_language_identification
from samples import SF, documents, nothing, odd  # noqa: F401


def test_held_out_accuracy(spark, documents):
    out = op3_language_identification(spark, SF).join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(out) > 30 and (out["lang"] == out["lang_pred"]).mean() > 0.97
    assert out["score"].between(0, 1).all() and out["rejected"].mean() < 0.03


def test_id_and_source_are_no_inputs(spark, documents):
    model = language.train_language_model(documents)
    a = language.identify(documents.select("doc_id", "text"), model).select("doc_id", "lang_pred", "score")
    b = language.identify(documents.withColumn("source", F.lit("x")).withColumn("lang", F.lit("zz")), model).select("doc_id", "lang_pred", "score")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_odd_rows(odd, nothing, documents):
    model = language.train_language_model(documents)
    by = {r["doc_id"]: r for r in language.identify(odd, model).collect()}
    for k in (2, 3, 4, 8):
        assert by[k]["lang_pred"] == "und" and by[k]["score"] == 0 and by[k]["rejected"]
    assert by[1]["lang_pred"] == "en" and by[7]["lang_pred"] != "und"
    assert language.identify(nothing, model).count() == 0


def test_no_labels(odd):
    model = language.train_language_model(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.identify(odd, model).collect()} == {"und"}


def test_copies_do_not_fill_the_sample(spark, documents):
    """A text copied thousands of times is one of the drawn texts, so the model still knows every language."""
    copy = documents.orderBy(F.xxhash64("text")).limit(1).crossJoin(spark.range(3000)).select(*documents.columns)
    model = language.train_language_model(documents.unionByName(copy), max_docs=120)
    assert set(model.languages) == {r["lang"] for r in documents.select("lang").distinct().collect()}


def test_least_hashes(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("h"), "id")
    both = rows.unionByName(rows.where("id % 3 = 0"))
    got = language.lowest_hashes(both, 700, F.count("*").alias("n"), F.min("id").alias("id")).collect()
    want = sorted(rows.collect())[:700]
    assert sorted((r["h"], r["id"]) for r in got) == [tuple(r) for r in want] and {r["n"] for r in got} == {1, 2}
    assert len(language.lowest_hashes(rows.limit(9), 700, F.min("id").alias("id")).collect()) == 9


def test_rows_without_id_are_not_held_out(spark, documents, tmp_path):
    some = documents.withColumn("doc_id", F.when(F.col("doc_id") % 7 > 0, F.col("doc_id")))
    some.write.parquet(str(tmp_path / "documents.parquet"))
    out = op3_language_identification(spark, str(tmp_path)).where("doc_id IS NULL")
    assert {r["held_out"] for r in out.collect()} == {False}
