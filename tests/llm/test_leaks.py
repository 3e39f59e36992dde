"""Benchmark items in documents against exact search and exact edit distances."""

import random

import pyarrow as pa
import pytest

from ledgerlens.llm import leaks
from ledgerlens.llm.queries import op5_benchmark_decontamination
from samples import SF, documents, nothing, odd  # noqa: F401


def symbols(text):
    return next(leaks._symbols(pa.array([text])))[1]


def test_every_exact_occurrence_is_found(spark, documents):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in op5_benchmark_decontamination(spark, SF).collect()}
    exact = {(d["doc_id"], i) for d in documents.collect() for i, t in items if t in d["text"]}
    assert exact and exact <= set(got) and all(got[k] == 0 for k in exact)
    by = {r["doc_id"]: r["text"] for r in documents.collect()}
    for (d, i), distance in got.items():
        assert leaks.edit_distance(symbols(dict(items)[i]), symbols(by[d])) <= distance <= 0.2 * len(symbols(dict(items)[i]))


def test_edited_items(spark):
    rnd = random.Random(5)
    words = [f"v{i}" for i in range(3000)]
    items = [(k, " ".join(rnd.choices(words, k=rnd.randrange(15, 60)))) for k in range(30)]
    docs, due = [], 0
    for n in range(300):
        item = items[n % 30][1].split()
        edited = []
        for w in item:
            u = rnd.random()
            edited += [] if u < 0.04 else [rnd.choice(words)] if u < 0.08 else [rnd.choice(words), w] if u < 0.12 else [w.upper() + ","]
        docs.append((n, " ".join(rnd.choices(words, k=50) + edited + rnd.choices(words, k=50))))
    clean = [(1000 + n, " ".join(rnd.choices(words, k=200))) for n in range(50)]
    frames = spark.createDataFrame(docs + clean, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks.leaks(*frames).collect()}
    want = set()
    for n, t in docs:
        item = symbols(items[n % 30][1])
        if leaks.edit_distance(item, symbols(t)) <= int(0.2 * len(item)):
            want.add((n, n % 30))
    assert len(want) > 200 and len(want & got) >= 0.97 * len(want) and got <= want
    assert leaks.without_leaks(*frames).count() == 350 - len({d for d, _ in got})


def test_edit_distance():
    a = symbols("one two three four five")
    assert leaks.edit_distance(a, symbols("zero one two three four five six")) == 0
    assert leaks.edit_distance(a, symbols("one two four five")) == 1
    assert leaks.edit_distance(a, symbols("")) == 5


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "a text without an id that is long enough to count here"), (4, "the cat")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in leaks.leaks(odd, items).collect()] == [(None, 3)]
    assert leaks.without_leaks(odd, items).count() == odd.count() - 1
    assert leaks.leaks(nothing, items).count() == 0 and leaks.leaks(odd, items.limit(0)).count() == 0


@pytest.mark.parametrize("length", [5, 6, 7, 8, 9, 10, 12, 15, 20, 40, 150])
def test_every_length_at_the_limit(length):
    rnd = random.Random(length)
    pool = [f"u{i}" for i in range(5000)]
    limit = leaks.edits(length, 0.8)
    items, texts, owner = [], [], []
    for n in range(60):
        item = rnd.sample(pool, length)
        items.append((n, symbols(" ".join(item))))
        for how in ("verbatim", "substituted", "mixed", "even"):
            edited = [[w] for w in item]
            at = [] if how == "verbatim" else [length * k // limit for k in range(limit)] if how == "even" else rnd.sample(range(length), limit)
            for k in at:
                edited[k] = [rnd.choice(pool)] if how != "mixed" else rnd.choice([[], [rnd.choice(pool)], [rnd.choice(pool), *edited[k]]])
            passage = [w for part in edited for w in part]
            ends = ([], []) if n % 4 == 0 else (rnd.choices(pool, k=20), rnd.choices(pool, k=20))
            texts.append(" ".join([*ends[0], *passage, *ends[1]]))
            owner.append(n)
    _, words, rows = next(leaks._symbols(pa.array(texts)))
    found = {(row, i): d for row, i, d in leaks._search(leaks._Items(items, 0.8), words, rows)}
    want = {(r, n): leaks.edit_distance(items[n][1], symbols(t)) for r, (t, n) in enumerate(zip(texts, owner))}
    assert all(d <= limit for d in want.values()) and {k: found.get(k) for k in want} == want


def test_a_short_item_at_the_end_of_a_document(spark):
    item = "one two three four five"
    docs = [(1, item), (2, "before it " + item), (3, item + " behind it"), (4, "one two six four five"), (5, "one two six seven five")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    assert {(r["doc_id"], r["distance"]) for r in leaks.leaks(*frames).collect()} == {(1, 0), (2, 0), (3, 0), (4, 1)}


def test_items_of_one_to_four_words(spark):
    rnd = random.Random(11)
    pool = [f"w{i}" for i in range(40)]
    items = [(n, " ".join(rnd.choices(pool, k=1 + n % 4))) for n in range(40)] + [(90, "..."), (91, " ")]
    docs = [(n, " ".join(rnd.choices(pool, k=rnd.randrange(0, 30)))) for n in range(200)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(d, i, 0, len(t.split())) for d, text in docs for i, t in items if i < 90 and f" {t} " in f" {text} "}
    assert len(want) > 200 and {tuple(r) for r in leaks.leaks(*frames, min_words=1).collect()} == want
    assert {r["item_id"] % 4 for r in leaks.leaks(*frames, min_words=3).collect()} <= {2, 3}
