"""Repeated byte strings: a depth-limited most-significant-digit radix sort of the suffixes, by digits that follow the content.

Two suffixes belong to one group if their first `depth` bytes agree. The digits by which groups are split are

1. the anchor: the least 32-byte string (by hash) among those that start in the suffix's first depth bytes, with its offset. Neighbouring
   suffixes share their anchor, so one row stands for a run of them, and a run whose anchor stands nowhere else is finished;
2. the whole run: the bytes that all suffixes of a run cover together. Runs that agree in it are repeated suffix by suffix;
3. the suffix itself, among those at the same offset from an anchor.

Only groups that are still open go on to the next digit. After the last, groups of two or more are exactly the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialise

from .common import mix, prefix_sums, span_hash, text_chunks

ANCHOR = 32
PIECE = 1 << 20
MOST_RUNS = 4096
_POSITION = np.uint64(PIECE - 1)


def anchors(sums: np.ndarray, depth: int) -> np.ndarray:
    """Position of the anchor of each suffix of a piece: the leftmost least hash among the next depth - ANCHOR + 1 places."""
    n = len(sums) - 1
    wide = depth - ANCHOR + 1
    at = np.arange(n - ANCHOR + 1)
    value = (span_hash(sums, at, at + ANCHOR) & ~_POSITION) | at.astype(np.uint64)
    # least of every window: running minima from both ends of blocks as wide as the window
    fill = -len(value) % wide
    blocks = np.concatenate([value, np.full(fill, ~np.uint64(0))]).reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - depth + 1
    return (np.minimum(behind[:count], ahead[wide - 1 : wide - 1 + count]) & _POSITION).astype(np.int64)


def _pieces(column: pa.Array, depth: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, start, bytes) of overlapping pieces: every suffix of `depth` bytes starts in exactly one of them."""
    for first, data, offsets in text_chunks(column):
        for i in range(len(offsets) - 1):
            text = data[offsets[i] : offsets[i + 1]]
            step = PIECE - depth
            for start in range(0, max(1, len(text) - depth + 1), step):
                piece = text[start : start + step + depth - 1]
                if len(piece) >= depth:
                    yield first + i, start, piece


def _runs(texts: DataFrame, depth: int) -> DataFrame:
    """(row, tail, text) to the runs of suffixes with a common anchor: first and last start, the anchor's hash and offset behind the
    first start, and the digest of all bytes covered and of where the anchor stands in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            size = 0
            rows, tails = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, start, piece in _pieces(batch.column(2), depth):
                sums = prefix_sums(piece)
                where = anchors(sums, depth)
                cut = np.flatnonzero(np.diff(where)) + 1
                begin = np.concatenate([np.zeros(1, np.int64), cut])
                end = np.concatenate([cut - 1, np.array([len(where) - 1])])
                anchor = where[begin]
                shape = mix(span_hash(sums, begin, end + depth) + (anchor - begin).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
                parts.append((
                    np.full(len(begin), rows[row]), np.full(len(begin), tails[row]), begin + start, end + start,
                    span_hash(sums, anchor, anchor + ANCHOR).view(np.int64), (anchor - begin).astype(np.int32), shape.view(np.int64),
                ))
                size += len(begin)
                if size > 50_000:
                    yield _packed(parts)
                    parts, size = [], 0
            if parts:
                yield _packed(parts)

    return texts.mapInArrow(run, "row long, tail long, first long, last long, anchor long, offset int, shape long")


def _packed(parts: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c)) for c in zip(*parts)], names=["row", "tail", "first", "last", "anchor", "offset", "shape"]
    )


def _bodies(open_runs: DataFrame, texts: DataFrame, depth: int) -> DataFrame:
    """The open runs with the bytes that their suffixes cover together."""
    asked = open_runs.groupBy("row", "tail").agg(F.collect_list(F.struct("first", "last", "anchor", "offset")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(3)[i].as_py().encode()
                lists = batch.column(4)[i].values
                first, last = (lists.field(k).to_numpy(zero_copy_only=False) for k in range(2))
                n = len(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column(0)[i].as_py())), pa.array(np.full(n, batch.column(1)[i].as_py(), np.int64)), lists.field(0), lists.field(2), lists.field(3),
                     pa.array([text[a : b + depth] for a, b in zip(first.tolist(), last.tolist())], pa.binary())],
                    names=["row", "tail", "first", "anchor", "offset", "body"],
                )

    return texts.join(asked, ["row", "tail"]).select("row", "tail", "id", "text", "asked").mapInArrow(
        run, "row long, tail long, first long, anchor long, offset int, body binary"
    )


def _suffix_digests(batch: pa.RecordBatch, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every suffix of the runs in a batch: its run, its place in the run, and the digest of its bytes."""
    bodies = batch.column(5).cast(pa.large_binary())
    offsets = np.frombuffer(bodies.buffers()[1], np.int64, count=len(bodies) + 1 + bodies.offset)[bodies.offset :]
    data = np.frombuffer(bodies.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets - offsets[0]
    length = np.diff(starts) - depth + 1
    owner = np.repeat(np.arange(len(length)), length)
    inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    at = starts[owner] + inside
    return owner, inside, span_hash(prefix_sums(data), at, at + depth)


def _whole_groups(bodies: DataFrame, depth: int) -> DataFrame:
    """Repeated suffixes among the runs of each anchor, for anchors whose runs fit a task: partitioned and sorted by anchor."""

    def found(table: pa.Table) -> pa.RecordBatch:
        batch = table.combine_chunks().to_batches()[0]
        parts = []
        step = 2000
        anchor = batch.column(3).to_numpy()
        cut = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1, [len(anchor)]])
        at = 0
        while at < len(cut) - 1:
            # whole anchors, about `step` runs at once
            upto = max(at + 1, int(np.searchsorted(cut, cut[at] + step, side="right")) - 1)
            own = batch.slice(cut[at], cut[upto] - cut[at])
            at = upto
            owner, inside, digest = _suffix_digests(own, depth)
            offset = own.column(4).to_numpy()[owner] - inside
            key = mix(digest ^ mix(own.column(3).to_numpy()[owner].view(np.uint64) + offset.astype(np.uint64)))
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            twice = np.zeros(len(key), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            # neighbouring suffixes of a run as one row
            hit = np.flatnonzero(twice)
            if len(hit) == 0:
                continue
            fresh = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(owner[hit]) > 0)])
            begin, end = hit[fresh], np.concatenate([hit[np.flatnonzero(fresh)[1:] - 1], hit[-1:]])
            first = own.column(2).to_numpy()[owner[begin]]
            parts.append((own.column(0).to_numpy()[owner[begin]], own.column(1).to_numpy()[owner[begin]], first + inside[begin], first + inside[end]))
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "tail", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            anchor = batch.column(3).to_numpy()
            last = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on in the next batch
            if last:
                yield found(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield found(pa.Table.from_batches(held))

    return bodies.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "row long, tail long, first long, last long")


def _split_groups(bodies: DataFrame, depth: int) -> DataFrame:
    """The same for anchors with more runs: every suffix is a row, counted by its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                owner, inside, digest = _suffix_digests(part, depth)
                take = lambda k: part.column(k).to_numpy()[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (take(0), take(1), take(2) + inside, take(3), (take(4) - inside).astype(np.int32), digest.view(np.int64))],
                    names=["row", "tail", "first", "anchor", "offset", "digest"],
                )

    suffixes = bodies.mapInArrow(run, "row long, tail long, first long, anchor long, offset int, digest long")
    groups = suffixes.groupBy("anchor", "offset", "digest").agg(F.count("*").alias("m")).filter("m > 1").drop("m")
    return suffixes.join(groups, ["anchor", "offset", "digest"], "left_semi").select("row", "tail", "first", F.col("first").alias("last"))


def repeated_spans(texts: DataFrame, depth: int = 200) -> DataFrame:
    """(row, tail, id, text) to (row, tail, first, last): starts of the strings of `depth` bytes that also start elsewhere."""
    runs = _runs(texts.select("row", "tail", "text"), depth)
    # digit 1: an anchor that stands once ends its run
    anchored = runs.groupBy("anchor").agg(F.count("*").alias("n"), F.min("shape").alias("low"), F.max("shape").alias("high")).filter("n > 1")
    # written first: a join of two plain shuffles is one whose hot anchors Spark splits
    several = materialise(anchored.select("anchor", (F.col("low") < F.col("high")).alias("forked")))
    left = materialise(runs.join(several, "anchor"))
    # digit 2: runs that agree as a whole are repeated, suffix by suffix
    shaped = materialise(left.groupBy("anchor", "shape", "forked").agg(F.count("*").alias("n"), F.min(F.struct("row", "tail", "first", "last", "offset")).alias("one")))
    whole = left.join(shaped.filter("n > 1").select("anchor", "shape"), ["anchor", "shape"], "left_semi").select("row", "tail", "first", "last")
    # last digit: the suffixes of one run for each shape of an anchor that has several
    open_runs = shaped.filter("forked").select("one.*", "anchor")
    large = materialise(open_runs.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > MOST_RUNS).select("anchor"))
    bodies = _bodies(open_runs, texts, depth)
    if large.isEmpty():
        return whole.union(_whole_groups(bodies, depth))
    small = _whole_groups(bodies.join(large, "anchor", "left_anti").select(bodies.columns), depth)
    return whole.union(small).union(_split_groups(bodies.join(large, "anchor", "left_semi").select(bodies.columns), depth))


def remove_repeats(docs: DataFrame, depth: int = 200, id: str = "doc_id", text: str = "text", remaining: bool = False) -> DataFrame:
    """One row a document: id, n_bytes, n_removed, n_spans, kept_sha256, and with `remaining` the bytes left (`kept`).

    Every byte covered by a string of `depth` bytes that also starts anywhere else, in the same or another document, goes; strings
    are judged on the input. Null texts are empty; rows without id and rows that repeat an id are documents of their own.
    A row without id is known by 128 bits of its text's SHA-256, another by its id and 64 bits of a hash of its text.
    """
    digest = F.sha2(F.coalesce(text, F.lit("")), 256)
    # never null, so that both joins of the texts share one shuffle
    half = lambda at: F.coalesce(F.conv(F.substring(digest, at, 16), 16, -10).cast("long"), F.lit(0))
    texts = docs.select(
        F.coalesce(F.col(id).cast("long"), half(1)).alias("row"), F.when(F.col(id).isNull(), half(17)).otherwise(F.xxhash64(F.coalesce(text, F.lit("")))).alias("tail"),
        F.col(id).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"),
    )
    spans = repeated_spans(texts, depth)
    listed = spans.groupBy("row", "tail").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * remaining

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py().encode()
                cover = np.zeros(len(raw) + 1, np.int64)
                if batch.column(2)[i].is_valid:
                    lists = batch.column(2)[i].values
                    np.add.at(cover, lists.field(0).to_numpy(zero_copy_only=False), 1)
                    np.add.at(cover, lists.field(1).to_numpy(zero_copy_only=False) + depth, -1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                begins = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((batch.column(0)[i].as_py(), len(raw), int(gone.sum()), begins, hashlib.sha256(kept).hexdigest(), kept)[: 5 + remaining])
                held += len(kept) * remaining
                if held > PIECE or i == batch.num_rows - 1:
                    columns = list(zip(*out))
                    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + remaining]
                    )
                    out, held = [], 0

    return (
        texts.join(listed, ["row", "tail"], "left").select("id", "text", "spans").mapInArrow(run, schema).withColumnRenamed("id", id)
    )
