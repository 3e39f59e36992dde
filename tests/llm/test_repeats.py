"""Repeated byte strings against brute force."""

import collections
import hashlib
import random

import pytest

from ledgerlens.llm import repeats
from ledgerlens.llm.queries import op1_suffix_array_dedup
from samples import SF, documents, nothing, odd  # noqa: F401


def brute(texts, depth):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[k : k + depth] for b in raw for k in range(len(b) - depth + 1))
    out = []
    for b in raw:
        mark = bytearray(len(b))
        for k in range(len(b) - depth + 1):
            if seen[b[k : k + depth]] > 1:
                mark[k : k + depth] = b"\1" * depth
        kept = bytes(x for x, m in zip(b, mark) if not m)
        spans = sum(1 for k in range(len(b)) if mark[k] and not (k and mark[k - 1]))
        out.append((len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compared(spark, texts, depth):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove_repeats(docs, depth).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, depth)


@pytest.mark.parametrize("depth", [40, 64, 200])
def test_planted_repeats(spark, depth):
    rnd = random.Random(depth)
    word = lambda n: "".join(rnd.choice("abcdeé ") for _ in range(n))
    shared = [word(rnd.randrange(depth - 3, 3 * depth)) for _ in range(6)]
    texts = ["".join(rnd.choice([*shared, word(rnd.randrange(5, depth))]) for _ in range(rnd.randrange(1, 6))) for _ in range(40)]
    compared(spark, [*texts, None, "", texts[0], "z" * (depth - 1), "z" * depth, "y" * (3 * depth), "ab" * depth], depth)


def test_pieces_of_a_long_text(spark, monkeypatch):
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcdefgh") for _ in range(3000))
    monkeypatch.setattr(repeats, "PIECE", 1 << 9)
    monkeypatch.setattr(repeats, "_POSITION", repeats.np.uint64((1 << 9) - 1))
    got = list(repeats._pieces(repeats.pa.array([text]), 60))
    starts = [s for _, start, piece in got for s in range(start, start + len(piece) - 59)]
    assert starts == list(range(len(text) - 59))


def test_query(spark, documents):
    rows = documents.select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op1_suffix_array_dedup(spark, SF).collect()}
    assert got == dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows], 200)))


def test_odd_rows(odd, nothing):
    out = repeats.remove_repeats(odd, 200, remaining=True).collect()
    assert len(out) == odd.count()
    by = {r["doc_id"]: r for r in out}
    assert by[2]["n_bytes"] == 0 and by[3]["n_removed"] == 0 and by[5]["n_removed"] == by[5]["n_bytes"] and by[6]["kept"].endswith(b" end")
    assert repeats.remove_repeats(nothing).count() == 0


def test_texts_without_id_whose_short_hashes_collide(spark):
    shared = "".join(random.Random(3).choice("abcdefgh ") for _ in range(270))
    other = "concat(sha2(string(id), 512), sha2(concat(id, 'b'), 512))"
    spark.range(400_000).selectExpr("id", f"IF(id % 2 = 0, concat('{shared}', id), {other}) AS text").selectExpr("id", "text", "hash(text, true) AS h").createOrReplaceTempView("collisions")
    pair = spark.sql("SELECT min_by(text, id % 2) AS a, max_by(text, id % 2) AS b FROM collisions GROUP BY h HAVING count(DISTINCT id % 2) = 2 LIMIT 1").first()
    assert pair["a"].startswith(shared) and not pair["b"].startswith(shared)
    docs = spark.createDataFrame([(None, pair["a"]), (None, pair["b"]), (1, shared)], "doc_id long, text string")
    got = {(r["doc_id"], r["n_bytes"]): (r["n_removed"], r["kept_sha256"]) for r in repeats.remove_repeats(docs, 200).collect()}
    assert got[None, len(pair["b"])] == (0, hashlib.sha256(pair["b"].encode()).hexdigest())
    assert got[None, len(pair["a"])][0] == got[1, 270][0] == 270
