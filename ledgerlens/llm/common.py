"""Helpers shared by the text operators: vectorised words, batches of bounded size, durable tables, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import materialise

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for at least n positions."""
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        if len(_POWERS) > 3:
            _POWERS.clear()

        def run(step: int) -> np.ndarray:
            out = np.full(size, step, dtype=np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        _POWERS[size] = run(_BASE), run(_BASE_INVERSE)
    up, down = _POWERS[size]
    return up[:n], down[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: one more entry than bytes."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes in [start, end), wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of a text column as (first row, bytes, offsets): about `limit` bytes each, null as empty, never a part of a row."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1 + column.offset)[column.offset :]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ASCII white space) and the first word of each row."""
    if len(data) == 0:
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(offsets), np.int64)
    solid = ~WHITE[data]
    begin, finish = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    finish[:-1] &= ~solid[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begin[edges] |= solid[edges]
    finish[edges - 1] |= solid[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of each word (A-Z lower-cased), its start and end, and the first word of each row."""
    starts, ends, first = words(data, offsets)
    sums = prefix_sums(LOWER[data] if lower else data)
    return span_hash(sums, starts, ends), starts, ends, first


def shingle_sets(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, and their offsets; shorter rows give their whole sequence."""
    parts, bounds = [], [0]
    if len(hashes) >= size:
        rolled = np.zeros(len(hashes) - size + 1, np.uint64)
        for k in range(size):
            rolled = rolled * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[k : k + len(rolled)]
        rolled = mix(rolled)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            parts.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                short = mix(short * np.uint64(0xC2B2AE3D27D4EB4F) + h)
            parts.append(short)
        else:
            parts.append(np.zeros(0, np.uint64))
        bounds.append(bounds[-1] + len(parts[-1]))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array(bounds)


def lowest_hashes(hashed: DataFrame, n: int, *picked) -> DataFrame:
    """The `n` least distinct values of column `h`, with the aggregates `picked` over the rows of each; written out.

    Hashes are spread evenly, so the number of distinct ones tells how far to read: only about a fifth more than `n` rows meet in one task, however
    many rows, tasks or copies there are. `hashed` should be narrow.
    """
    kept = materialise(hashed)
    seen = kept.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    if seen > n:
        share = min(1.0, 1.2 * n / seen + 50 / seen)
        kept = kept.where(F.col("h") <= F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))))
    return materialise(kept.groupBy("h").agg(*picked).orderBy("h").limit(n))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable id (`component`) of every id in the edges: hooking to the least neighbour and pointer jumping.

    Each round is written to the shared folder, so a lost executor costs only that round. A label is an id of the
    same component and never grows, so the rounds end when no edge joins two labels.
    """
    links = materialise(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
        .select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
        .select("e.*").distinct()
    )
    labels = materialise(links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")))
    while True:
        owner = labels.select(F.col("u").alias("v"), F.col("label").alias("other"))
        near = links.join(owner, "v").groupBy("u").agg(F.min("other").alias("low"))
        hooked = labels.join(near, "u").select("u", "label", F.least("label", "low").alias("next"))
        # what a label's members have found also moves the label itself
        moved = hooked.groupBy(F.col("label").alias("u")).agg(F.min("next").alias("best"))
        step = hooked.join(moved, "u", "left").select("u", "label", F.least("next", F.coalesce("best", "next")).alias("next"))
        jump = step.select(F.col("u").alias("next"), F.col("next").alias("far"))
        done = materialise(
            step.join(jump, "next", "left").select("u", "label", F.least("next", F.coalesce("far", "next")).alias("to"))
        )
        if done.filter("to < label").isEmpty():
            return done.select(F.col("u").alias("id"), F.col("to").alias("component"))
        labels = done.select("u", F.col("to").alias("label"))
