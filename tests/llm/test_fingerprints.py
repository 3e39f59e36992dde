"""Fingerprints: votes, edited texts, block tables against all pairs."""

import hashlib
import random

from ledgerlens.llm import fingerprints
from ledgerlens.llm.queries import op4_document_fingerprints
from samples import SF, documents, nothing, odd  # noqa: F401


def test_edited_texts_and_likeness(spark, documents):
    docs = sorted((r["doc_id"], r["text"] or "") for r in documents.select("doc_id", "text").collect())
    after = {a[0]: b[1] for a, b in zip(docs, docs[1:] + docs[:1])}
    got = {r["doc_id"]: r for r in op4_document_fingerprints(spark, SF).collect()}
    seen = {}
    for i, text in docs:
        q = len(text) // 4
        edited = text[: len(text) - q] + after[i][:q]
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    ahead = [r["near_edited"] > r["near_next"] for r in got.values()]
    assert sum(ahead) > 0.95 * len(ahead)


def test_near_pairs_are_all_found(spark):
    rnd = random.Random(2)
    base = [(rnd.getrandbits(64), rnd.getrandbits(64)) for _ in range(20)]
    marks = set(base)
    for a, b in base:
        for _ in range(15):
            for _ in range(rnd.randrange(1, 5)):
                k = rnd.randrange(128)
                a, b = (a ^ (1 << k), b) if k < 64 else (a, b ^ (1 << (k - 64)))
            marks.add((a, b))
    signed = [tuple(v - (1 << 64) if v >= 1 << 63 else v for v in m) for m in marks]
    frame = spark.createDataFrame(signed + signed[:5], "f0 long, f1 long")
    apart = lambda x, y: sum(((p ^ q) & ((1 << 64) - 1)).bit_count() for p, q in zip(x, y))
    for radius, blocks in ((3, 4), (5, 8)):
        want = {tuple(sorted((x, y))) for i, x in enumerate(signed) for y in signed[:i] if apart(x, y) <= radius}
        got = {tuple(sorted(((r["a0"], r["a1"]), (r["b0"], r["b1"])))) for r in fingerprints.near_fingerprints(frame, radius, blocks).collect()}
        assert got == want and want


def test_no_python_in_the_plan(documents):
    plan = fingerprints.fingerprints(documents, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Pandas", "ArrowEval", "MapInArrow"))


def test_odd_rows(odd, nothing):
    out = fingerprints.fingerprint_documents(odd).collect()
    assert len(out) >= len({(r["doc_id"], r["text"]) for r in odd.collect()})
    by = {r["doc_id"]: r for r in out}
    assert by[2]["fingerprint"] == by[3]["fingerprint"] == "0" * 32 and by[None]["near_next"] == 0.0
    assert fingerprints.fingerprint_documents(nothing).count() == 0
