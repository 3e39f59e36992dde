"""Periodic runs of words: suffix automaton, last occurrences recoloured by link-cut access, squares extended to runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK_BYTES = 4 << 20
ADDED = ("n_words", "runs", "collapsed")
_NEVER = -(1 << 60)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_TYPE = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def find_runs(ids: list[int], begin: int, end: int, least: int, exponent: int) -> list[tuple[int, int, int]]:
    """Runs (start, length, smallest period) within ids[begin:end] of at least `least` words and `exponent` (2 or more) periods.

    Words are appended to a suffix automaton. The path from a state to the root along suffix links holds all suffixes of a prefix; a
    link-cut forest keeps it as pieces, each with the word at which its strings ended last. Appending word i gives the path of its prefix
    the colour i. Where a piece changes hands from colour j, the longest string that ended at both is `span` long: if it covers the
    distance d = i - j, a square of period d ends here, and the stretch of span + d words is the run so far, as far left as it goes. It is
    reported at its last word. A shorter period would have left a later colour, so d is the smallest one.
    """
    # node 0 stands for none, node 1 is the root; `seen` holds for the top node of a splay tree
    span, link, step = [0, 0], [0, 0], [{}, {}]
    up, left, right, seen = [0, 0], [0, 0], [0, 0], [begin - 1, begin - 1]
    out: list[tuple[int, int, int]] = []

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = right[x]
            left[p], right[x] = b, p
        else:
            b = left[x]
            right[p], left[x] = b, p
        up[b], up[p], up[x] = p, x, g
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
        else:
            seen[x] = seen[p]

    def splay(x: int) -> None:
        p = up[x]
        while left[p] == x or right[p] == x:
            g = up[p]
            if left[g] == p:
                rotate(p if left[p] == x else x)
            elif right[g] == p:
                rotate(p if right[p] == x else x)
            rotate(x)
            p = up[x]

    def state(length: int, parent: int, steps: dict) -> int:
        span.append(length)
        link.append(parent)
        step.append(steps)
        up.append(parent)
        left.append(0)
        right.append(0)
        seen.append(0)
        return len(span) - 1

    last = 1
    for i in range(begin, end):
        word = ids[i]
        new = state(span[last] + 1, 0, {})
        p = last
        while p and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p == 0:
            parent = 1
        else:
            parent = q = step[p][word]
            if span[q] != span[p] + 1:
                # the shorter strings of q get a state of their own, right above q on its path and of its colour
                parent = state(span[p] + 1, link[q], step[q].copy())
                splay(q)
                above = left[q]
                left[parent], up[parent], left[q] = above, q, parent
                up[above] = parent
                link[q] = parent
                while p and step[p].get(word) == q:
                    step[p][word] = parent
                    p = link[p]
        link[new] = up[new] = parent
        last = below = new
        node = parent
        while node:
            splay(node)
            before = seen[node]
            period = i - before
            common = span[node]
            if common >= period:
                length = common + period
                if length >= least and length >= exponent * period and (i + 1 == len(ids) or ids[i + 1] != ids[i + 1 - period]):
                    out.append((i - length + 1, length, period))
            rest = right[node]
            if rest:
                seen[rest] = before
            right[node], up[below] = below, node
            below, node = node, up[node]
        seen[below] = i
    return out


def gaps(words: list) -> list[int]:
    """Distance of each word to its previous occurrence; very large at the first one."""
    last: dict = {}
    out = []
    for i, w in enumerate(words):
        out.append(i - last.get(w, _NEVER))
        last[w] = i
    return out


def stretches(distance: np.ndarray, firsts: np.ndarray, least: int, exponent: int) -> list[tuple[int, int]]:
    """Ranges of the concatenated words that hold every run; `firsts` are the first words of the texts, with the end.

    After its first period q every word of a run was seen at most q words before. So a run with q in (h/2, h] lies in a stretch of
    distances of at most h, long enough for the least length and exponent, and the h words before it.
    """
    longest = int(np.diff(firsts).max(initial=0))
    found: list[tuple[int, int]] = []
    h = 1
    while True:
        low = h // 2 + 1
        if exponent * low > longest:
            break
        need = max((exponent - 1) * low, least - h, 1)
        far = np.append(np.flatnonzero(distance > h), len(distance))
        at = np.flatnonzero(np.diff(far) - 1 >= need)
        begins = far[at] + 1
        texts = firsts[np.searchsorted(firsts, begins, side="right") - 1]
        found += zip(np.maximum(begins - h, texts).tolist(), far[at + 1].tolist())
        h *= 2
    merged: list[list[int]] = []
    for a, b in sorted(found):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


def runs_of_texts(texts: list[list], least: int, exponent: int) -> list[list[tuple[int, int, int]]]:
    """Runs of each text, a list of words, ordered by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    firsts = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    distance = np.fromiter((g for t in texts for g in gaps(t)), dtype=np.int64, count=int(firsts[-1]))
    numbered = -1
    for a, b in stretches(distance, firsts, least, exponent):
        k = int(np.searchsorted(firsts, a, side="right")) - 1
        if k != numbered:
            number: dict = {}
            ids = [number.setdefault(w, len(number)) for w in texts[k]]
            numbered = k
        first = int(firsts[k])
        out[k] += find_runs(ids, a - first, b - first, least, exponent)
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period : start + length] = b"\x01" * (length - period)
    return b" ".join(w for w, g in zip(words, gone) if not g)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows with about CHUNK_BYTES of text, one row at least."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // CHUNK_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def collapse_runs(docs: DataFrame, text: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """Every row with `n_words`, `runs` (start, length, period; by start, then period) and `collapsed`, replacing columns of these names.

    A run is a stretch of words (`[^\\x20\\x09-\\x0D]+`) with smallest period q and at least max(least, exponent * q) words that no neighbouring word
    extends. `collapsed` joins by one space the words that no run holds after its first q words. A null or blank text has no words, no runs and
    the empty string. Rows are independent: repeated rows and null ids need no care, and nothing is shuffled. A text is worked on whole, in one
    task; only the stretches that can hold runs (`stretches`) enter the automaton, which takes some 300 bytes a word.
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    kept = [c for c in docs.columns if c not in ADDED]
    place = kept.index(text)
    source = docs.select(*[f"`{c}`" for c in kept])
    schema = T.StructType([*source.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("runs", _RUN_TYPE), T.StructField("collapsed", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, place):
                # without arguments bytes are split at ASCII white space: 0x20 and 0x09 to 0x0D
                texts = [(t or b"").split() for t in batch.column(place).cast(pa.large_binary()).to_pylist()]
                runs = runs_of_texts(texts, least, exponent)
                rest = [without_repeats(t, r) for t, r in zip(texts, runs)]
                flat = [r for rs in runs for r in rs]
                offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([len(t) for t in texts], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, fields=list(_RUN))),
                     pa.array(rest, pa.binary()).cast(pa.string())],
                    names=[*kept, *ADDED],
                )

    return source.mapInArrow(work, schema)


# The registered query's result, with every period at every place compared.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda k: ord(CAST(doc_id AS VARCHAR)[k])::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295) AS h
  FROM documents),
e AS (SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS made, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a, 3 + (h // 10) % 8 AS k FROM d),
t AS (SELECT doc_id, n, CASE WHEN made THEN list_transform(ws, lambda w, j: CASE WHEN j - 1 < a THEN w ELSE ws[1 + a + (j - 1 - a) % (1 + (n - a) // k)] END) ELSE ws END AS ws FROM e),
w AS (SELECT doc_id, n, unnest(ws) AS w, unnest(range(n)) AS i FROM t),
m AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
g AS (SELECT doc_id, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island, i FROM m),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY doc_id, start, length),
b AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS list FROM r GROUP BY doc_id),
f AS (SELECT doc_id, start, length, period FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS rank FROM r) WHERE rank = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
c AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS collapsed FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(list, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN c USING (doc_id)
"""
