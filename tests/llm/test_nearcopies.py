"""Near-copies against brute force over all pairs."""

import itertools
import random
import re

import numpy as np
import pytest

from ledgerlens.llm import nearcopies
from ledgerlens.llm.queries import op10_minhash_near_dedup
from samples import SF, documents, nothing, odd  # noqa: F401


def shingles(text, size):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return set(zip(*[w[k:] for k in range(size)])) if len(w) >= size else ({tuple(w)} if w else set())


def brute(docs, size, percent):
    sets = {i: shingles(t, size) for i, t in docs}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_drifting_copies(spark, size, percent):
    rnd = random.Random(size)
    docs, words = [], [f"w{i}" for i in range(400)]
    for _ in range(12):
        text = rnd.choices(words, k=rnd.randrange(1, 90))
        for _ in range(rnd.randrange(1, 9)):
            docs.append((rnd.randrange(1 << 40), " ".join(text)))
            if rnd.random() < 0.7:
                text[rnd.randrange(len(text))] = rnd.choice(words).upper()
    docs += [(1 << 41, None), (1 << 42, " \t"), (1 << 43, docs[0][1].upper())]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in nearcopies.near_copies(spark.createDataFrame(docs, "doc_id long, text string"), size, percent).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in brute(docs, size, percent).items()}


def test_query(spark, documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op10_minhash_near_dedup(spark, SF).collect()}
    assert got == brute(docs, 3, 85)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = values[:2000], values[400:]
    regs = nearcopies.registers(np.concatenate([a, b, values]), np.array([0, 2000, 4600, 7600]), 256)
    assert (np.maximum(regs[0], regs[1]) == regs[2]).all()
    likely = nearcopies.estimate(regs[:1], regs[1:2], np.array([2000.0]), np.array([2600.0]))[0]
    assert abs(likely - 1600 / 3000) < 0.12


def test_odd_rows(odd, nothing):
    out = nearcopies.near_copies(odd).collect()
    assert len(out) == odd.count()
    by = {r["doc_id"]: r for r in out}
    assert by[6]["component_id"] == 5 and not by[6]["kept"] and by[2]["n_shingles"] == 0 and by[None]["kept"] and by[None]["component_id"] is None
    assert nearcopies.near_copies(nothing).count() == 0


def copies(rnd, count, edits, length=200):
    """Copies of one text with that many words changed, none near another change."""
    text = [f"w{i}" for i in range(length)]
    out = []
    for _ in range(count):
        own = list(text)
        for k in rnd.sample(range(0, length, 8), edits):
            own[k] = f"x{rnd.randrange(1 << 40)}"
        out.append(own)
    return out


def compared(spark, monkeypatch, docs, size=3, percent=85):
    """The result, and how many pairs were looked at."""
    seen, likely = [], nearcopies._likely

    def counted(pairs, *more):
        seen.append(pairs.count())
        return likely(pairs, *more)

    monkeypatch.setattr(nearcopies, "_likely", counted)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nearcopies.near_copies(spark.createDataFrame(docs, "doc_id long, text string"), size, percent).collect()}
    return got, sum(seen)


def test_large_group_below_the_limit_makes_few_pairs(spark, monkeypatch):
    docs = [(i, " ".join(t)) for i, t in enumerate(copies(random.Random(1), 150, 6))]
    got, pairs = compared(spark, monkeypatch, docs)
    assert got == brute(docs, 3, 85) and len({c for _, c in got.values()}) == 150
    assert pairs < 5 * len(docs)  # of 11175


def test_large_groups_around_the_limit(spark, monkeypatch):
    rnd, texts = random.Random(2), []
    for edits, count in ((0, 2), (1, 10), (2, 25), (3, 25), (4, 25), (5, 15)):
        texts += copies(rnd, count, edits)
    texts += [[*t[:90], *(f"y{k}" for k in range(14)), *t[104:]] for t in copies(rnd, 40, 2)]  # a second family beside the first
    texts += [[*t, *rnd.choices(t, k=rnd.randrange(60))] for t in copies(rnd, 30, 1)]  # of other lengths
    rnd.shuffle(texts)
    docs = [(i * 7, " ".join(t)) for i, t in enumerate(texts)]
    docs.append(docs[8])  # a row that comes twice
    got, _ = compared(spark, monkeypatch, docs)
    assert got == brute(docs, 3, 85)


def test_splits_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "FEW", 1)
    monkeypatch.setattr(nearcopies, "DRAWN", 1)  # any centre will do
    rnd = random.Random(3)
    docs = [(i, " ".join(t)) for i, t in enumerate(t for e in range(1, 7) for t in copies(rnd, 12, e, 120))]
    got, _ = compared(spark, monkeypatch, docs, 5, 80)
    assert got == brute(docs, 5, 80)
