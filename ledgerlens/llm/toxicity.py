"""Toxicity by a weighted finite-state grammar over clauses, with a lexicon and weights learned from labelled documents.

Five transducers run side by side over the words of a clause: insults (learned lexemes with weights), threats, targets, negation and
reported speech. Their composition tells for each insult in which context it stands, and for each threat verb whether somebody is
its target. A logistic model over the matched clauses of a document gives its score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialise

from .common import lowest_hashes, mix, shingle_sets, text_chunks, word_hashes

#: Words of the grammar in English, German, French and Spanish.
TARGETS = frozenset("you your yours yourself u he she they them him her his their du dich dir dein sie ihr euch tu te toi vous votre tú ti usted ustedes vosotros su".split())
NEGATIONS = frozenset("not no never neither nor isn aren don doesn wasn won cannot nicht kein keine keinen nie ne pas jamais aucun nunca jamás ni ningún".split())
REPORTS = frozenset(
    "said says say saying called calls wrote writes quoted quote reported claimed alleged according sagte sagt nannte schrieb laut dit disait écrit selon appelé dijo dice llamó escribió según".split()
)
THREATS = frozenset("kill kills hurt destroy shoot stab beat burn hang murder die töten umbringen schlagen verbrennen tuer frapper détruire brûler matar golpear destruir quemar".split())

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = re.compile(r"[.!?;:\n|]+")
_NEGATED_FOR, _THREAT_FOR = 3, 4
CONTEXTS = 8
FEATURES = CONTEXTS + 8
SHORTEST, LONGEST = 3, 8


def _state(word: str, state: tuple[int, int, int, int]) -> tuple[int, int, int, int]:
    """Next state of the composed transducers: words that negation still covers, reported?, targeted?, words a threat still awaits its target."""
    negated, reported, targeted, threat = state
    negated = _NEGATED_FOR if word in NEGATIONS else max(0, negated - 1)
    return negated, int(reported or word in REPORTS), int(targeted or word in TARGETS), _THREAT_FOR if word in THREATS else max(0, threat - 1)


def run_clause(words: list[tuple[str, float]]) -> tuple[np.ndarray, int]:
    """Insult weight by context (reported, negated, targeted), and threats aimed at someone. Each word comes with its insult weight or 0."""
    out, threats = np.zeros(CONTEXTS), 0
    state = (0, 0, 0, 0)
    for word, weight in words:
        waiting = state[3]
        state = _state(word, state)
        if weight:
            out[4 * state[1] + 2 * (state[0] > 0) + state[2]] += weight
        if waiting and word in TARGETS:
            threats += 1 if not state[1] else 0
    return out, threats


@dataclass
class ToxicityModel:
    lexemes: dict[str, float]  # a final * marks a stem
    coefficients: np.ndarray
    intercept: float
    centre: np.ndarray
    scale: np.ndarray


class _Matcher:
    def __init__(self, lexemes: dict[str, float]):
        self.automaton = ahocorasick.Automaton()
        for k, w in lexemes.items():
            stem = k.rstrip("*")
            whole = None if k.endswith("*") else w
            known = self.automaton.get(stem, (len(stem), None, None))
            self.automaton.add_word(stem, (len(stem), whole if whole is not None else known[1], w if whole is None else known[2]))
        for word in THREATS:
            if word not in self.automaton:
                self.automaton.add_word(word, (len(word), 0.0, None))
        self.automaton.make_automaton()

    def features(self, text: str) -> np.ndarray:
        """Context sums, threats, best clause, matched clauses, whole weight, whole weight for the length, and of the single insults:
        how many, whether two or more, and the second-largest weight."""
        out = np.zeros(FEATURES)
        text = text.lower()
        best: dict[int, float] = {}
        for end, (size, whole, stem) in self.automaton.iter(text):
            start = end + 1 - size
            if start and text[start - 1].isalpha():
                continue
            weight = stem or 0.0
            if whole is not None and not (end + 1 < len(text) and text[end + 1].isalpha()):
                weight = max(weight, whole)
            elif stem is None:
                continue
            best[start] = max(weight, best.get(start, 0.0))
        if not best:
            return out
        borders = [0] + [m.end() for m in _CLAUSE_END.finditer(text)] + [len(text)]
        for k in sorted({bisect_right(borders, s) - 1 for s in best}):
            a, b = borders[k], borders[k + 1] if k + 1 < len(borders) else len(text)
            found, threats = run_clause([(m[0], best.get(m.start(), 0.0)) for m in _WORD.finditer(text, a, b)])
            out[:CONTEXTS] += found
            out[CONTEXTS] += threats
            out[CONTEXTS + 1] = max(out[CONTEXTS + 1], found.sum())
            out[CONTEXTS + 2] += found.sum() > 0
        whole = out[:CONTEXTS].sum()
        out[CONTEXTS + 3] = whole
        out[CONTEXTS + 4] = whole / math.log(len(text) + 8)
        single = sorted(w for w in best.values() if w)
        out[CONTEXTS + 5] = len(single)
        out[CONTEXTS + 6] = len(single) > 1
        out[CONTEXTS + 7] = single[-2] if len(single) > 1 else 0.0
        return np.log1p(out)


def _marked(docs: DataFrame) -> DataFrame:
    """Adds two MinHashes of three-word shingles to (text, toxic), to keep one of several near-copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(0)):
                hashes, _, _, rows = word_hashes(data, offsets)
                sets, bounds = shingle_sets(hashes, rows, 3)
                least = [np.array([mix(sets[a:b] ^ np.uint64(k)).min() if b > a else 0 for a, b in zip(bounds[:-1], bounds[1:])], np.uint64).view(np.int64) for k in (1, 2)]
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(least[0]), pa.array(least[1])], names=["text", "toxic", "m1", "m2"])

    return docs.mapInArrow(run, "text string, toxic int, m1 long, m2 long")


def _lexicon_counts(sample: DataFrame) -> DataFrame:
    """Labelled documents with each word and each stem: (lexeme, toxic, all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(_WORD.findall(text.lower()))
                lexemes = words | {w[:k] + "*" for w in words for k in range(SHORTEST, min(LONGEST, len(w)) + 1)}
                yield pa.RecordBatch.from_arrays([pa.array(list(lexemes), pa.string()), pa.array([toxic] * len(lexemes), pa.int32())], names=["lexeme", "toxic"])

    return sample.select("text", "toxic").mapInArrow(run, "lexeme string, toxic int").groupBy("lexeme").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("all"))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, max_docs: int = 12_000, max_chars: int = 20_000, max_lexemes: int = 4000,
    id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> ToxicityModel:
    """Fits on a bounded sample of labelled documents: at most `max_docs` distinct texts of at most `max_chars` characters, chosen by a hash of the text.

    Labels and hashes meet on ids alone; only the drawn texts are read after that, by a broadcast of at most `max_docs` ids. Copies with different labels count as not toxic.

    Of near-copies one is kept, so words that only a group of copies shares are no evidence. A lexeme (a word, or a stem of 3 to 8
    letters) enters the lexicon if toxic documents hold it so much more often than others that its log-likelihood gain beats the log of
    the number of lexemes tried; its weight is the log of the odds ratio. A stem whose evidence is that of one longer lexeme is dropped.
    Without labelled rows every score is one half; without toxic or without other rows it is their share.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("__id")).agg(F.max(label).cast("int").alias("toxic"))
    texts = docs.select(F.col(id).alias("__id"), F.coalesce(text, F.lit("")).alias("text")).filter(F.length("text") <= max_chars).withColumn("h", F.xxhash64("text"))
    drawn = lowest_hashes(texts.select("__id", "h").join(known, "__id"), max_docs, F.min("__id").alias("__id"), F.min("toxic").alias("toxic"))
    read = texts.join(F.broadcast(drawn), ["__id", "h"]).groupBy("h").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))
    marked = _marked(materialise(read.select("text", "toxic")))
    for m in ("m1", "m2"):
        marked = marked.groupBy(m).agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "toxic", *[c for c in ("m1", "m2") if c != m])).alias("s")).select("s.*", m)
    sample = materialise(marked.select("text", "toxic"))
    n, bad = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = bad / n if n else 0.5
    if base in (0.0, 1.0) or not n:
        start = math.log((bad + 0.5) / (n - bad + 0.5))
        return ToxicityModel({}, np.zeros(FEATURES), start, np.zeros(FEATURES), np.ones(FEATURES))
    counts = materialise(_lexicon_counts(sample).filter(F.col("all") >= 4))
    tried = counts.count()
    p = F.col("toxic") / F.col("all")
    gain = F.col("toxic") * F.log(p / base) + F.when(p < 1, (F.col("all") - F.col("toxic")) * F.log((1 - p) / (1 - base))).otherwise(0)
    found = counts.filter((F.col("toxic") > 0) & (p > base)).withColumn("gain", gain).filter(F.col("gain") > math.log(max(tried, 2)))
    rows = {r["lexeme"]: (r["toxic"], r["all"]) for r in found.orderBy(F.desc("gain"), "lexeme").limit(max_lexemes).collect()}
    longer: dict[str, int] = {}
    for k, (t, _) in rows.items():
        stem = k.rstrip("*")
        for size in range(SHORTEST, len(stem) + (0 if k.endswith("*") else 1)):
            longer[stem[:size] + "*"] = max(t, longer.get(stem[:size] + "*", 0))
    lexemes = {
        k: math.log((t + 0.5) / (a - t + 0.5)) - math.log(base / (1 - base)) for k, (t, a) in rows.items()
        if not (k.endswith("*") and longer.get(k, 0) >= 0.95 * t)
    }
    lexemes = {k: w for k, w in lexemes.items() if w > 0}
    blank = ToxicityModel(lexemes, np.zeros(FEATURES), 0.0, np.zeros(FEATURES), np.ones(FEATURES))
    table = _with_features(sample, blank, "text").select("features", "toxic").toPandas()
    x, y = np.array(table["features"].tolist()), table["toxic"].to_numpy(float)
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    weights, start = _logistic((x - centre) / scale, y)
    return ToxicityModel(lexemes, weights, start, centre, scale)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression by Newton's method; the intercept is free."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-6] + [penalty] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[1:], float(w[0])


def _with_features(docs: DataFrame, model: ToxicityModel, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model.lexemes)
    kept = [f for f in docs.schema.fields if f.name not in (text, "features")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["features array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _Matcher(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = [matcher.features(t) if t else np.zeros(FEATURES) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in kept] + [pa.array(made, pa.list_(pa.float64()))], names=[f.name for f in kept] + ["features"])

    return docs.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, model: ToxicityModel, cut: float = 0.3, text: str = "text") -> DataFrame:
    """Adds `score` (0 to 1) and `predicted` (1 from `cut` on) to every row, from its whole text; null counts as empty.

    The text column is dropped, columns named like the results are replaced, all others kept. A text without a match gets the score of an empty one.
    """
    made = _with_features(docs.drop("score", "predicted"), model, text)
    terms = [f"{w / s!r}D * (features[{k}] - {c!r}D)" for k, (w, c, s) in enumerate(zip(model.coefficients.tolist(), model.centre.tolist(), model.scale.tolist()))]
    logit = " + ".join([f"{model.intercept!r}D", *terms])
    return made.withColumn("score", F.expr(f"1D / (1D + exp(-least(greatest({logit}, -30D), 30D)))")).withColumn("predicted", (F.col("score") >= cut).cast("int")).drop("features")
