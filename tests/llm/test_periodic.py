"""Periodic runs against all periods at all places, stretches against whole texts, the query against its SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest

from ledgerlens.llm import periodic, queries
from samples import SF, documents, nothing, odd  # noqa: F401


def brute(words, least, exponent):
    """Maximal runs by comparing every word with the one q before, for each q; the smallest period of a stretch counts."""
    n, smallest = len(words), {}
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            a = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - a >= max(least, exponent * q):
                smallest.setdefault((a, i - a), q)
    return sorted(((a, m, q) for (a, m), q in smallest.items()), key=lambda r: (r[0], r[2]))


def planted(rnd, letters):
    words = []
    for _ in range(rnd.randrange(1, 6)):
        words += [rnd.choice(letters) for _ in range(rnd.randrange(0, 12))]
        unit = [rnd.choice(letters) for _ in range(rnd.randrange(1, 9))]
        m = rnd.randrange(1, 50)
        words += [unit[k % len(unit)] for k in range(m)]
    return words


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (9, 3)])
def test_runs_equal_brute_force(least, exponent):
    rnd = random.Random(least)
    texts = [planted(rnd, "ab"[: rnd.randrange(1, 3)] if k % 3 == 0 else "abcdefgh") for k in range(400)]
    texts += [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 700, ["ab", "c"] * 300, list("abaababaabaababaababa" * 20)]
    want = [brute(t, least, exponent) for t in texts]
    assert periodic.runs_of_texts(texts, least, exponent) == want and sum(map(len, want)) > 300
    whole = [sorted(periodic.find_runs(t, 0, len(t), least, exponent), key=lambda r: (r[0], r[2])) for t in texts]
    assert whole == want


def test_long_texts_stay_fast():
    rnd = random.Random(5)
    unit = [f"w{rnd.randrange(10**9)}" for _ in range(7_001)]
    text = unit[:500] + unit * 5 + ["end"]
    assert periodic.runs_of_texts([text, ["x"] * 50_000], 6, 4) == [[(500, 35_005, 7_001)], [(0, 50_000, 1)]]


def test_collapsed_text(spark):
    rows = spark.createDataFrame([(1, "say it again it again it again it again it now"), (2, "la la la la la la la la"), (3, "no no no no no")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic.collapse_runs(rows).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(1, 9, 2)] and got[1]["collapsed"] == "say it again now"
    assert got[2]["runs"] == [] and got[3]["collapsed"] == "no no no no no" and got[2]["n_words"] == 7


def edited(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_equals_brute_force_and_sql(spark, documents):
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    for r in documents.select("doc_id", "text").collect():
        words = edited(r["doc_id"], r["text"])
        runs = brute(words, 6, 4)
        row = got[r["doc_id"]]
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert row["n_runs"] == len(runs) and (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == digest("".join("%d,%d,%d\n" % x for x in runs).encode())
        assert row["collapsed_sha256"] == digest(b" ".join(w for k, w in enumerate(words) if k not in gone))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = con.execute(queries.ORACLE["op13_periodic_runs"])
    names = [c[0] for c in sql.description]
    assert {tuple(r) for r in sql.fetchall()} == {tuple(r[n] for n in names) for r in got.values()} and len(got) == 200


def test_odd_rows(odd, nothing):
    wide = odd.withColumnsRenamed({"n_removed": "runs", "features": "collapsed"})
    out = periodic.collapse_runs(wide).collect()
    assert len(out) == odd.count() and out[0].asDict().keys() >= {"doc_id", "score", "runs", "collapsed", "n_words"}
    assert [(r["n_words"], r["runs"], r["collapsed"]) for r in out if r["doc_id"] == 2] == [(0, [], "")]
    assert periodic.collapse_runs(nothing).count() == 0
