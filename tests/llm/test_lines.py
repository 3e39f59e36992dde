"""Repeated multi-line chunks: SQL, removal, shift resistance."""

import hashlib
import random

import duckdb
import pytest

from ledgerlens.llm import lines
from ledgerlens.llm.queries import op6_line_dedup
from samples import SF, documents, nothing, odd  # noqa: F401


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    names = ["doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", "kept_sha256"]
    want = {tuple(r) for r in con.execute(f"SELECT {', '.join(names)} FROM ({lines.ORACLE})").fetchall()}
    assert {tuple(r) for r in op6_line_dedup(spark, SF).select(*names).collect()} == want


def test_a_shifted_passage_goes_but_for_its_first_place(spark):
    passage = [f"shared line {i} of the passage" for i in range(30)]
    docs = [(2, "\n".join(["a", *passage, "b"])), (1, "\n".join([f"own {i}" for i in range(7)] + passage))]
    out = {r["doc_id"]: r for r in lines.drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[1]["n_removed_lines"] == 0 and out[1]["text"] == docs[1][1]
    assert out[2]["n_removed_lines"] >= 20 and out[2]["text"].split("\n")[0] == "a"


@pytest.mark.parametrize("native", ["Python", "Pandas", "Arrow"])
def test_no_python_in_the_plan(documents, native):
    plan = lines.drop_repeated_lines(documents)._jdf.queryExecution().executedPlan().toString()
    assert native not in plan.replace("ArrowEval", "ArrowEval" if native == "Arrow" else "")


def test_odd_rows(odd, nothing):
    out = lines.drop_repeated_lines(odd.withColumnRenamed("n_removed", "n_removed_lines")).collect()
    assert len(out) == odd.count()
    assert [r["text"] for r in out if r["doc_id"] == 2] == [None] and [r["n_lines"] for r in out if r["doc_id"] == 3] == [1]
    assert lines.drop_repeated_lines(nothing).count() == 0


def brute(docs):
    """Lines left of (id, text), in this order, by comparing all neighbouring lines with those before."""
    seen, out = set(), []
    for _, text in docs:
        ls = text.split("\n")
        gone = set()
        for i in range(len(ls) - 1):
            if ls[i].strip(" ") or ls[i + 1].strip(" "):
                gone |= {i, i + 1} if (ls[i], ls[i + 1]) in seen else set()
                seen.add((ls[i], ls[i + 1]))
        out.append((len(ls), len(gone), "\n".join(x for i, x in enumerate(ls) if i not in gone)))
    return out


def test_passages_equal_brute_force(spark):
    rnd = random.Random(6)
    line = lambda: rnd.choice([f"common {rnd.randrange(12)}", f"own {rnd.random()}", "", " "])
    docs = [(n, "\n".join(line() for _ in range(rnd.randrange(1, 25)))) for n in range(150)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: (r["n_lines"], r["n_removed_lines"], r["text"]) for r in lines.drop_repeated_passages(frame).collect()}
    assert [got[n] for n, _ in docs] == brute(docs)


def test_short_passages_and_whole_copies_go(spark):
    two = [(n, "first line\nsecond line") for n in range(3)]
    inside = [(10 + n, f"a {n}\nb {n}\nfirst line\nsecond line\nc {n}") for n in range(20)]
    frame = spark.createDataFrame(two + inside, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in lines.drop_repeated_passages(frame).collect()}
    assert [out[n] for n in range(3)] == [two[0][1], "", ""]
    assert all(out[10 + n] == f"a {n}\nb {n}\nc {n}" for n in range(20))


def test_passages_of_rows_that_share_an_id(spark):
    docs = [(None, "a\nb\nc"), (None, "x\ny\nz"), (7, "x\ny\nmore"), (8, "own\ntext"), (8, "own\ntext"), (9, "q\na\nb")]
    out = sorted((r["doc_id"] or 0, r["text"]) for r in lines.drop_repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert out == [(0, "a\nb\nc"), (0, "x\ny\nz"), (7, "more"), (8, "own\ntext"), (8, "own\ntext"), (9, "q")]


def test_odd_passages(odd, nothing):
    out = lines.drop_repeated_passages(odd).collect()
    assert len(out) == odd.count() and [r["text"] for r in out if r["doc_id"] == 2] == [None] and [r["n_lines"] for r in out if r["doc_id"] == 3] == [1]
    assert lines.drop_repeated_passages(nothing).count() == 0


def test_pipeline_drops_a_two_line_copy(spark):
    import corpus_pipeline

    frame = spark.createDataFrame([(n, "first line\nsecond line", 22) for n in range(3)], "doc_id long, text string, n_chars long")
    assert [r["doc_id"] for r in corpus_pipeline.fresh_lines(spark, frame, SF).collect()] == [0]


def value(line):
    return int(hashlib.md5(line.encode()).hexdigest()[:8], 16)


def chunks_of(text):
    """Chunks of a text, by the stated rule alone."""
    out, chunk, before = [], [], 0
    for line in text.split("\n"):
        chunk.append(line)
        if (5 * value(line) + 7 * before) % 3 == 0:
            out.append(chunk)
            chunk = []
        before = value(line)
    return out + [chunk] * bool(chunk)


def test_first_lines_and_two_line_copies_can_go(spark):
    """Whole copies of two and more lines: each multi-line chunk of a copy goes, the one that line 1 begins too."""
    rnd = random.Random(3)
    texts = ["\n".join(f"line {rnd.random()}" for _ in range(rnd.choice([2, 2, 2, 3, 6]))) for _ in range(60)]
    docs = [(n, texts[n % 60]) for n in range(120)]
    out = {r["doc_id"]: r for r in lines.drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"), factors=lines.FACTORS).collect()}
    for n, text in docs:
        kept = [c for c in chunks_of(text) if n < 60 or len(c) == 1]
        assert out[n]["text"] == "\n".join("\n".join(c) for c in kept)
    pairs = [out[n]["text"] for n, t in docs[60:] if t.count("\n") == 1]
    firsts = [n for n, t in docs[60:] if len(chunks_of(t)[0]) > 1]
    assert pairs.count("") > len(pairs) / 2 and all(not out[n]["text"].startswith(docs[n][1].split("\n")[0]) for n in firsts) and len(firsts) > 20


def test_both_lines_decide_on_a_boundary():
    f, g = lines.FACTORS
    ends = {(a, b): (f * a + g * b) % lines.DIVISOR == 0 for a in range(3) for b in range(3)}
    assert len({ends[a, 0] for a in range(3)}) == 2 and len({ends[1, b] for b in range(3)}) == 2


def test_sql_and_query_agree_on_nulls_and_empty_texts(spark):
    rows = [(1, None), (2, ""), (3, "a\nb\nc\nd"), (4, "a\nb\nc\nd"), (5, "x\na\nb\nc\nd\n"), (6, "\n\n"), (7, "\n\n")]
    names = ["doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", "kept_sha256"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), factors=lines.FACTORS).selectExpr(*names[:-1], "sha2(coalesce(text, ''), 256) AS kept_sha256").collect()
    assert {tuple(r) for r in got} == set(con.execute(f"SELECT {', '.join(names)} FROM ({lines.ORACLE})").fetchall())
