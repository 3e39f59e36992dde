"""The pipeline: columns, decisions, and each stage against the stage's own operator or brute force."""

import corpus_pipeline
from ledgerlens.llm import leaks
from ledgerlens.llm.queries import QUERIES
from samples import SF, documents, nothing, odd  # noqa: F401


def test_registry():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "bpe"]


def test_stages(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        before, after = {r["doc_id"] for r in docs.collect()}, {r["doc_id"] for r in out.collect()}
        assert after <= before and out.count() == len(after)
        if name != "bpe":
            assert out.columns == documents.columns
        if name == "decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
            held = {d["doc_id"] for d in docs.collect() if any(i["text"] in d["text"] for i in items)}
            assert held and not held & after and leaks.leaks(out, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
        if name == "bpe":
            assert after == before and all(len(r["ids"]) == 4 * r["n_tokens"] for r in out.collect())
        docs = out
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == {r["doc_id"] for r in docs.collect()}


def test_odd_documents(spark, odd, nothing):
    for frame in (odd, nothing):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() <= frame.count()
