"""Shards: even sizes, whole groups, quotas, links of other kinds, files."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerlens.llm import queries, shards
from samples import SF, documents, nothing, odd  # noqa: F401


def test_query_contract(spark, documents):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in documents.select("doc_id", "text").collect()}
    rows = queries.op11_balanced_shards(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs) and {r["law"] for r in rows} == {"bytes"}
    for r in rows:
        assert r["size"] == len(docs[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(docs[r["doc_id"]]) and r["grown_shard"] is None
    slots, bytes_, homes = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        bytes_[r["shard"]] += r["size"]
        homes[docs[r["doc_id"]]].add(r["shard"])
    assert set(slots) == set(range(40)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    mean, largest = sum(bytes_.values()) / 40, max(r["size"] for r in rows)
    together = Counter(docs.values())
    assert all(len(v) == 1 for t, v in homes.items() if together[t] * (len(t) + 16) <= mean)  # others do not fit a shard
    assert max(bytes_.values()) <= max(1.05 * mean, largest + mean * 0.1)


@pytest.mark.parametrize("free, slack", [(6000, 1.002), (0, 1.02)])
def test_hot_and_small_groups(spark, free, slack):
    rnd = random.Random(free)
    groups = [3000] + [400, 150] + [rnd.randrange(2, 9) for _ in range(500)]
    rows, links, k = [], [], 0
    for g, n in enumerate(groups):
        size = rnd.randrange(50, 900)
        for _ in range(n):
            rows.append((k, size))
            links.append((k, g))
            k += 1
    for _ in range(free):
        rows.append((k, rnd.randrange(16, 3000)))
        links.append((k, 10_000 + k))
        k += 1
    items, pairs = spark.createDataFrame(rows, "item long, size long"), spark.createDataFrame(links, "item long, hub int")
    got = {r["item"]: r["shard"] for r in shards.assign_shards(items, pairs, 16).collect()}
    assert len(got) == len(rows) and set(got.values()) == set(range(16))
    load, homes, hub, size = Counter(), defaultdict(set), dict(links), dict(rows)
    for i, s in got.items():
        load[s] += size[i]
        homes[hub[i]].add(s)
    mean = sum(load.values()) / 16
    assert max(load.values()) <= slack * mean and min(load.values()) >= mean * (2 - slack)
    cut = [g for g, n in enumerate(groups) if len(homes[g]) > 1]
    heavy = {g for g in range(len(groups)) if sum(size[i] for i, h in links if h == g) > mean}
    if free:
        assert set(cut) == heavy and all(len(homes[g]) <= 1 + sum(size[i] for i, h in links if h == g) / mean for g in heavy)
    else:
        assert len(cut) < 0.2 * len(groups)


def test_chains_of_links(spark):
    """Items with two hubs each: rings of neighbours fall apart in few places."""
    rows = [(k, 100) for k in range(1200)]
    links = [(k, f"{k // 30}-{e}") for k in range(1200) for e in (k % 30, (k + 1) % 30)]
    got = {r["item"]: r["shard"] for r in shards.assign_shards(spark.createDataFrame(rows, "item long, size long"), spark.createDataFrame(links, "item long, hub string"), 8).collect()}
    cut = sum(got[k] != got[k // 30 * 30 + (k + 1) % 30] for k in range(1200))
    load = Counter(got.values())
    assert max(load.values()) <= 151 and cut < 0.55 * 1200  # 7 of 8 links are cut at the start


def test_level_and_quotas():
    assert shards.level([5, 1, 3], 6) == [0, 4, 2] and shards.level([0, 0], 0) == [0, 0] and shards.level([2, 2, 9], 3) == [1.5, 1.5, 0]
    assert shards.level([1, 2, 3], 30) == [11, 10, 9]
    allowed = shards.quotas({(0, 1): 10, (1, 0): 4, (2, 1): 6}, [50, 40, 0], 46)
    assert allowed == {(0, 1): 4 + 0.5 * 6, (1, 0): 4, (2, 1): 3}


def test_files(spark, documents, tmp_path):
    placed = shards.shard_texts(documents, keep=("doc_id", "text"), shards=5)
    shards.write_shards(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == documents.count() and back.select("text").exceptAll(documents.select("text")).isEmpty()
    assert len(list((tmp_path / "out" / "shard=3").glob("*.parquet"))) == 1


def test_odd_rows(odd, nothing):
    wide = odd.withColumnsRenamed({"n_removed": "shard", "features": "item"})
    out = shards.shard_texts(wide, shards=3).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r["doc_id"]) for r in odd.collect())
    by = {r["doc_id"]: r for r in out}
    assert by[2]["size"] == by[3]["size"] == 16 and by[2]["text_crc32"] == 0 and by[2]["shard"] == by[3]["shard"]
    assert sorted((r["shard"], r["slot"]) for r in out) == [(s, k) for s in range(3) for k in range(sum(r["shard"] == s for r in out))]
    assert shards.shard_texts(nothing, shards=3).count() == 0
