"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lowest_hashes, text_chunks

UNKNOWN = "und"
BUCKETS = 1 << 15
DIM = 16
SIZES = (2, 3, 4)
# letters keep their byte, anything else is a word border
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class LanguageModel:
    """`table` holds each bucket's class scores (embedding times class weights): averages are linear, so they need no more."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of a chunk, and the row each belongs to; grams do not cross rows and are not blank."""
    padded = np.full(len(data) + len(offsets), 32, np.uint8)  # a border after each row, and one before the first
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    padded[np.arange(len(data)) + row + 1] = _FOLD[data]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 1)
    wide = padded.astype(np.uint32)
    out, rows = [], []
    for n in SIZES:
        if len(padded) < n + 1:
            continue
        end = len(padded) - n + 1
        h = np.full(end, n, np.uint32)
        for k in range(n):
            h *= np.uint32(0x01000193)
            h ^= wide[k : k + end]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        # the gram starts and ends in one row (a border may be shared), and holds at least one letter among its first two bytes
        first, last = owner[np.minimum(np.arange(end), len(owner) - 1)], owner[np.minimum(np.arange(end) + n - 2, len(owner) - 1)]
        good = (first == last) & ((padded[:end] != 32) | (padded[1 : end + 1] != 32))
        out.append((h[good] >> np.uint32(17)).astype(np.int32))
        rows.append(first[good])
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(rows)


def _logits(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams, rows = _grams(data, offsets)
    n = len(offsets) - 1
    count = np.bincount(rows, minlength=n)
    out = np.stack([np.bincount(rows, weights=model.table[:, c][grams], minlength=n) for c in range(len(model.languages))], axis=1)
    return out / np.maximum(count, 1)[:, None] + model.bias, count


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_language_model(
    docs: DataFrame, usable: Column | None = None, text: str = "text", lang: str = "lang",
    max_docs: int = 4000, max_chars: int = 20_000, epochs: int = 6, kept_share: float = 0.999, seed: int = 7,
) -> LanguageModel:
    """Fits on a bounded sample, in one task: at most `max_docs` labelled documents of at most `max_chars` characters, chosen by a hash of the text.

    The bound counts distinct texts: copies stand for one (of several languages the first). Hashes are drawn first, then only their texts are read.

    A fifth of the sample is held back: on it the softmax temperature is fitted, and the rejection threshold is set so that
    `kept_share` of its rightly named documents pass (one half at most). Without labelled rows the model knows no language.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= max_chars))
    if usable is not None:
        rows = rows.filter(usable)
    rows = rows.select(F.col(text).alias("t"), F.col(lang).alias("l"), F.xxhash64(text).alias("h"))
    drawn = lowest_hashes(rows.select("h", "l"), max_docs, F.min("l").alias("l"))
    # max_docs small rows; of copies every task hands on one text
    sample = rows.select("t", "h").join(F.broadcast(drawn), "h").groupBy("h").agg(F.min("t").alias("t"), F.min("l").alias("l")).select("t", "l")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            drawn = pa.Table.from_batches(held)
            model = _fit(drawn.column(0).combine_chunks(), drawn.column(1).to_pylist(), epochs, kept_share, seed)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    fitted = sample.coalesce(1).mapInArrow(run, "model binary").collect()  # one row, or none without labels
    return pickle.loads(fitted[0][0]) if fitted else LanguageModel((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)


def _fit(texts: pa.Array, langs: list[str], epochs: int, kept_share: float, seed: int) -> LanguageModel:
    """Training on the drawn sample, in one task."""
    languages = tuple(sorted(set(langs)))
    texts = pc.utf8_lower(texts.cast(pa.large_string()))
    target = np.searchsorted(np.array(languages), np.array(langs, dtype=str))
    features: list[tuple[np.ndarray, np.ndarray]] = []
    for _, data, offsets in text_chunks(texts):
        grams, owner = _grams(data, offsets)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(len(offsets)))
        for a, b in zip(bounds[:-1], bounds[1:]):
            ids, counts = np.unique(grams[order[a:b]], return_counts=True)
            features.append((ids, (counts / max(1, counts.sum())).astype(np.float32)))
    rng = np.random.default_rng(seed)
    classes = len(languages)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weights = rng.normal(0, 0.3, (classes, DIM)).astype(np.float32)
    bias = np.zeros(classes, np.float32)
    order = rng.permutation(len(features))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    for epoch in range(epochs):
        rate = np.float32(1.0 - epoch / epochs)
        for at in range(0, len(used), 16):
            batch = [i for i in used[at : at + 16] if len(features[i][0])]
            if not batch:
                continue
            ids = np.concatenate([features[i][0] for i in batch])
            share = np.concatenate([features[i][1] for i in batch])
            bounds = np.cumsum([0] + [len(features[i][0]) for i in batch[:-1]])
            mean = np.add.reduceat(embed[ids] * share[:, None], bounds, axis=0)
            grad = _softmax(mean @ weights.T + bias)
            grad[np.arange(len(batch)), target[batch]] -= 1
            back = grad @ weights
            sizes = np.array([len(features[i][0]) for i in batch])
            weights -= rate * 0.5 * (grad.T @ mean) / len(batch)
            bias -= rate * 0.05 * grad.mean(axis=0)
            # a bucket's step is scaled up: its share of a document is small
            np.subtract.at(embed, ids, rate * np.float32(8.0) * np.repeat(back, sizes, axis=0) * share[:, None])
        used = rng.permutation(used)
    table = embed @ weights.T
    scored = np.stack([(table[features[i][0]] * features[i][1][:, None]).sum(axis=0) + bias for i in held]) if len(held) else np.zeros((0, classes))
    temperature, threshold = 1.0, 0.0
    if len(held):
        truth = target[held]
        options = np.geomspace(0.25, 8.0, 41)
        loss = [-np.log(np.maximum(_softmax(scored / t)[np.arange(len(held)), truth], 1e-9)).mean() for t in options]
        temperature = float(options[int(np.argmin(loss))])
        p = _softmax(scored / temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == truth]
        threshold = float(min(0.5, np.quantile(right, 1 - kept_share))) if len(right) else 0.0
    return LanguageModel(languages, np.ascontiguousarray(table.astype(np.float32)), bias.astype(float), temperature, threshold)


def _has_letter(data: np.ndarray) -> bool:
    if ((data >= 97) & (data <= 122) | (data >= 65) & (data <= 90)).any():
        return True
    return bool((data >= 128).any()) and any(map(str.isalpha, data.tobytes().decode("utf-8", "replace")))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Adds `lang_pred`, `score` (calibrated, 0 to 1) and `rejected` to every row, from the whole text only.

    Null texts and texts without a letter are `und` with score 0 and rejected; so are all if the model knows no language.
    Other texts get the likeliest learned language and are rejected below the calibrated threshold. Columns with these three
    names are replaced, all others kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "rejected")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["lang_pred string", "score double", "rejected boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lowered = pc.utf8_lower(batch.column(text).cast(pa.large_string()))
            named, scores = [], []
            for _, data, offsets in text_chunks(lowered):
                n = len(offsets) - 1
                if not known.languages:
                    named += [UNKNOWN] * n
                    scores += [0.0] * n
                    continue
                z, _ = _logits(known, data, offsets)
                p = _softmax(z / known.temperature)
                best, top = p.argmax(axis=1), p.max(axis=1)
                for i in range(n):
                    some = _has_letter(data[offsets[i] : offsets[i + 1]])
                    named.append(known.languages[best[i]] if some else UNKNOWN)
                    scores.append(float(top[i]) if some else 0.0)
            flags = [a == UNKNOWN or s < known.threshold for a, s in zip(named, scores)]
            columns = [batch.column(f.name) for f in kept] + [pa.array(named, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + ["lang_pred", "score", "rejected"])

    return docs.mapInArrow(run, schema)
