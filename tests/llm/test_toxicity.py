"""Toxicity: grammar contexts, held-out quality, odd rows."""

from pyspark.sql import functions as F

from ledgerlens.llm import toxicity
from ledgerlens.llm.queries import op9_toxicity
from samples import documents, nothing, odd  # noqa: F401

BIG = "/root/testdata/sf0.1"


def test_contexts_of_the_grammar():
    read = lambda text, bad=("idiot",): toxicity.run_clause([(w, 2.0 if w in bad else 0.0) for w in text.split()])
    assert read("what an idiot")[0].tolist() == [2.0, 0, 0, 0, 0, 0, 0, 0]
    assert read("you idiot")[0][1] == 2.0 and read("not an idiot")[0][2] == 2.0 and read("she said idiot")[0][5] == 2.0
    assert read("i will kill you")[1] == 1 and read("he said i will kill you")[1] == 0 and read("i kill time alone often and you")[1] == 0


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    out = op9_toxicity(spark, BIG).join(labels, "doc_id").filter("held_out").toPandas()
    bad, good = out[out.toxic == 1], out[out.toxic == 0]
    assert len(bad) > 50 and bad.predicted.mean() > 0.8 and good.predicted.mean() < 0.02 and out.score.between(0, 1).all()
    assert ((out.score >= 0.3) == (out.predicted == 1)).all()


def test_labels_of_held_out_rows_do_not_matter(spark, odd, nothing, documents):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(odd, labels)
    out = toxicity.score_toxicity(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score_toxicity(nothing, model).count() == 0
    empty = toxicity.train_toxicity(odd, labels.limit(0))
    assert {r["score"] for r in toxicity.score_toxicity(odd, empty).select(F.round("score", 6).alias("score")).collect()} == {0.5}


def test_rows_without_id_are_not_held_out(spark, tmp_path):
    some = spark.read.parquet(f"{BIG}/documents.parquet").limit(500).withColumn("doc_id", F.when(F.col("doc_id") % 7 > 0, F.col("doc_id")))
    some.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{BIG}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    out = op9_toxicity(spark, str(tmp_path)).where("doc_id IS NULL")
    assert {r["held_out"] for r in out.collect()} == {False}
