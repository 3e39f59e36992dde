"""Benchmark passages in documents: unedited pieces of items looked up at every word, exact edit verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, powers, prefix_sums, span_hash, text_chunks, words

PAIRS = 1_000_000
CELLS = 2_000_000
BLOCK_WORDS = 2_000_000
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def edits(words: int, share: float) -> int:
    """Word edits that an item of so many words may be away."""
    return int(words * (1 - share) + 1e-9)


def _stretches(symbols: np.ndarray, length: int) -> np.ndarray:
    """One key for each stretch of `length` words."""
    n = max(0, len(symbols) - length + 1)
    key = np.full(n, length, np.uint64)
    for k in range(length):
        key = key * np.uint64(0xC2B2AE3D27D4EB4F) + symbols[k : k + n]
    return mix(key)


def _symbols(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, word hashes (lower case, without ASCII punctuation) and the first word of each row."""
    for first, data, offsets in text_chunks(pc.utf8_lower(column.cast(pa.large_string()))):
        keep = ~_PUNCTUATION[data]
        moved = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])[offsets]
        data = data[keep]
        starts, ends, rows = words(data, moved)
        powers(len(data) + 1)
        yield first, span_hash(prefix_sums(data), starts, ends), rows


def edit_distance(item: np.ndarray, region: np.ndarray) -> int:
    """Least number of word edits that turn the item into some stretch of the region."""
    steps = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for k, word in enumerate(item):
        nxt = np.empty_like(row)
        nxt[0] = k + 1
        nxt[1:] = np.minimum(row[:-1] + (region != word), row[1:] + 1)
        row = np.minimum.accumulate(nxt - steps) + steps
    return int(row.min())


class _Items:
    """Items cut into one piece more than they may have edits: at least one piece of an item stands unedited in every passage within the limit."""

    def __init__(self, rows: list[tuple[int, np.ndarray]], share: float):
        self.words = [w for _, w in rows]
        self.ids = [i for i, _ in rows]
        self.allowed = [edits(len(w), share) for w in self.words]
        made: dict[int, tuple[list, list, list]] = {}
        for i, (w, k) in enumerate(zip(self.words, self.allowed)):
            cut = [len(w) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cut, cut[1:]):
                for column, value in zip(made.setdefault(b - a, ([], [], [])), (_stretches(w[a:b], b - a)[0], i, a)):
                    column.append(value)
        self.pieces = {}
        for length, (keys, items, places) in made.items():
            keys = np.array(keys, np.uint64)
            order = np.argsort(keys, kind="stable")
            maybe = np.zeros(1 << 21, bool)
            maybe[(keys >> np.uint64(43)).astype(np.int64)] = True
            self.pieces[length] = keys[order], np.array(items)[order], np.array(places)[order], maybe


def _distances(word: np.ndarray, allowed: int, starts: np.ndarray, begins: np.ndarray, ends: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Least edits that turn the item into a stretch of each window that opens at a start, or more than allowed. Windows end with their row."""
    window = starts[:, None] + np.arange(len(word) + 3 * allowed)
    inside = (window >= begins[:, None]) & (window < ends[:, None])
    seen = symbols[np.clip(window, 0, len(symbols) - 1)]
    known, item = np.unique(word, return_inverse=True)
    code = np.minimum(np.searchsorted(known, seen), len(known) - 1)
    code = np.where(inside & (known[code] == seen), code, -1)
    out = np.full(len(starts), len(word) + 1)
    # every edit takes at most one word of the item away
    near = np.flatnonzero((code >= 0).sum(axis=1) >= len(word) - allowed)
    code = code[near]
    steps = np.arange(code.shape[1] + 1)
    row = np.zeros((len(near), len(steps)), np.int64)
    for k, c in enumerate(item):
        nxt = np.empty_like(row)
        nxt[:, 0] = k + 1
        nxt[:, 1:] = np.minimum(row[:, :-1] + (code != c), row[:, 1:] + 1)
        row = np.minimum.accumulate(nxt - steps, axis=1) + steps
    out[near] = row.min(axis=1)
    return out


def _search(items: _Items, symbols: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, item, distance) of every passage of a chunk within the limit."""
    best: dict[tuple[int, int], int] = {}
    for length, (keys, owners, offsets, maybe) in items.pieces.items():
        stretches = _stretches(symbols, length)
        hit = np.flatnonzero(maybe[(stretches >> np.uint64(43)).astype(np.int64)])
        low, high = np.searchsorted(keys, stretches[hit]), np.searchsorted(keys, stretches[hit], side="right")
        hit, low, count = hit[high > low], low[high > low], (high - low)[high > low]
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
        at = 0
        while at < len(hit):
            upto = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, side="right")) - 1)
            place, some = np.repeat(hit[at:upto], count[at:upto]), count[at:upto]
            entry = np.repeat(low[at:upto], some) + np.arange(some.sum()) - np.repeat(total[at:upto] - total[at], some)
            at = upto
            owner, row = owners[entry], np.searchsorted(rows, place, side="right") - 1
            step = np.array(items.allowed)[owner] + 1
            # neighbouring starts of an item share a window
            bucket = (place - offsets[entry]) // step
            order = np.lexsort((bucket, row, owner))
            owner, row, bucket = owner[order], row[order], bucket[order]
            fresh = np.ones(len(owner), bool)
            fresh[1:] = (np.diff(owner) != 0) | (np.diff(row) != 0) | (np.diff(bucket) != 0)
            owner, row, bucket = owner[fresh], row[fresh], bucket[fresh]
            cut = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(owner)]
            for a, b in zip(cut, cut[1:]):
                i = int(owner[a])
                word, allowed = items.words[i], items.allowed[i]
                many = max(1, CELLS // (len(word) + 3 * allowed))
                for c in range(a, b, many):
                    own = row[c : min(b, c + many)]
                    found = _distances(word, allowed, bucket[c : c + len(own)] * (allowed + 1) - allowed, rows[own], rows[own + 1], symbols)
                    for k in np.flatnonzero(found <= allowed):
                        pair = int(own[k]), i
                        best[pair] = min(int(found[k]), best.get(pair, allowed))
    return [(row, i, d) for (row, i), d in sorted(best.items())]


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.8, min_words: int = 5, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document and benchmark item that it holds: id, item_id, distance, item_words.

    A document holds an item if some stretch of it is at most (1 - share) of the item's words edits away (word edits, lower case, without
    ASCII punctuation). The search is exact: an item that may have k edits is cut into k + 1 pieces, one of which must stand in the passage
    unedited; items below five words stand unedited as a whole. Items below `min_words` words, and those without words, are not searched (the query and the
    pipeline search from one word up). Null texts hold nothing and are no items; rows without id are searched and come with a null id. The benchmark is the stated query set: it is read in
    blocks of at most BLOCK_WORDS words, each sent to the executors and searched against all documents.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    spark = docs.sparkSession
    out = None
    block: list[tuple[int, np.ndarray]] = []
    size = 0

    def search(part: list[tuple[int, np.ndarray]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _Items(shared.value, share)
            for batch in batches:
                for first, symbols, rows in _symbols(batch.column(1)):
                    hits = _search(items, symbols, rows)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array([first + h[0] for h in hits], pa.int64())), pa.array([items.ids[h[1]] for h in hits], pa.int64()),
                        pa.array([h[2] for h in hits], pa.int64()), pa.array([len(items.words[h[1]]) for h in hits], pa.int64()),
                    ], names=["id", "item_id", "distance", "item_words"])

        return docs.select(F.col(id).cast("long"), text).mapInArrow(run, "id long, item_id long, distance long, item_words long")

    for row in benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL").toLocalIterator():
        for _, symbols, _ in _symbols(pa.array([row[1]], pa.large_string())):
            if len(symbols) >= max(1, min_words):
                block.append((row[0], symbols))
                size += len(symbols)
        if size >= BLOCK_WORDS:
            out = search(block) if out is None else out.union(search(block))
            block, size = [], 0
    if block or out is None:
        if block:
            out = search(block) if out is None else out.union(search(block))
        else:
            out = spark.createDataFrame([], "id long, item_id long, distance long, item_words long")
    return out.withColumnRenamed("id", id).distinct()


def without_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", **settings) -> DataFrame:
    """The documents that hold no benchmark item; rows without id are judged by their own text."""
    bad = leaks(docs, benchmark, id=id, **settings).select(F.col(id).alias("__bad")).distinct()
    return docs.join(bad, F.col(id).eqNullSafe(F.col("__bad")), "left_anti")
