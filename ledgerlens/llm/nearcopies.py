"""Near-copies by SetSketch: mergeable registers, banded; joint likelihood estimate; exact check on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialise

from .common import components, mix, shingle_sets, text_chunks, word_hashes

BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 2
LOSS = 1e-7
MOST_REGISTERS = 256
MOST_SPLITS = 3
FEW = 4
DRAWN = 31
SPREAD = 4096


def band_plan(share: float, loss: float = LOSS) -> tuple[int, int]:
    """Registers a band and bands: the longest bands with which a pair at the wanted similarity meets in none with probability
    `loss` at most, within MOST_REGISTERS registers. Equal minima give equal registers, so a register agrees at least
    as often as the sets are similar."""
    plan = (1, 1)
    for rows in range(1, 17):
        bands = math.ceil(math.log(loss) / math.log1p(-min(share**rows, 1 - 1e-12)))
        if rows * bands > MOST_REGISTERS:
            break
        plan = rows, bands
    return plan


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return base[:n], base[n:] | np.uint64(1)


def registers(sets: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """One row of `count` registers for each set: the truncated logarithm of the least exponential variate of its elements.

    The variate falls as the element's hash rises, so the least variate is that of the least hash. Registers of a union are
    the larger of the registers. An empty set has registers 0.
    """
    n = len(bounds) - 1
    out = np.zeros((n, count), np.uint16)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled) == 0:
        return out
    starts = bounds[:-1][filled]
    add, times = _seeds(count)
    for j in range(count):
        least = np.minimum.reduceat((sets ^ add[j]) * times[j], starts)
        variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
        level = np.floor(1 - np.log(np.maximum(variate, 1e-300)) / math.log(BASE))
        # RATE keeps the registers of one-element sets above 0, BASE those of the largest sets below the top
        out[filled, j] = np.clip(level, 0, TOP + 1).astype(np.uint16)
    return out


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity of each pair of register rows, given how many registers are larger, smaller and equal."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - above - below
    u, v = na / (na + nb), nb / (na + nb)
    most = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 101)[None, :] * most[:, None]

    def chance(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE), 1e-12, 1)

    up, down = chance(u[:, None] - v[:, None] * grid), chance(v[:, None] - u[:, None] * grid)
    equal = np.clip(1 - up - down, 1e-12, 1)
    fit = above[:, None] * np.log(up) + below[:, None] * np.log(down) + same[:, None] * np.log(equal)
    return grid[np.arange(len(grid)), fit.argmax(axis=1)]


def _sets(batch: pa.RecordBatch, text: int, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for first, data, offsets in text_chunks(batch.column(text)):
        hashes, _, _, rows = word_hashes(data, offsets)
        yield first, *shingle_sets(hashes, rows, size)


def sketch(docs: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """(id, text) to id, n_shingles, a 128-bit digest of the set, its registers, and one key for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets, bounds in _sets(batch, 1, size):
                n = len(bounds) - 1
                regs = registers(sets, bounds, rows * bands)
                keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)).copy()
                for k in range(rows):
                    keys = mix(keys * np.uint64(0xC2B2AE3D27D4EB4F) + regs[:, k::rows][:, :bands].astype(np.uint64))
                count = np.diff(bounds)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets * np.uint64(k)))]) for k in (3, 5)]
                digest = [(s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array(count, pa.int64()), pa.array(digest[0]), pa.array(digest[1]),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(keys.view(np.int64).ravel())),
                ], names=["id", "n_shingles", "d1", "d2", "registers", "bands"])

    return docs.mapInArrow(run, "id long, n_shingles long, d1 long, d2 long, registers binary, bands array<long>")


def _likely(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """Pairs whose estimate is not far below the wanted similarity (five standard deviations)."""
    side = reps.select("rep", "n_shingles", "registers")
    wide = (
        pairs.join(side.withColumnsRenamed({"rep": "a", "n_shingles": "na", "registers": "ra"}), "a")
        .join(side.withColumnsRenamed({"rep": "b", "n_shingles": "nb", "registers": "rb"}), "b")
        .filter(F.least("na", "nb") >= F.greatest("na", "nb") * least)  # the smaller set bounds the similarity
        .select("a", "b", "na", "nb", "ra", "rb")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in (4, 5))
            na, nb = (batch.column(c).to_numpy().astype(float) for c in (2, 3))
            slack = 5 * math.sqrt(least * (1 - least) / ra.shape[1])
            good = estimate(ra, rb, na, nb) >= least - slack
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))

    return wide.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union, on the full sets."""
    wide = (
        pairs.join(sets.withColumnsRenamed({"rep": "a", "hashes": "ha"}), "a").join(sets.withColumnsRenamed({"rep": "b", "hashes": "hb"}), "b")
        .select("a", "b", "ha", "hb")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                good.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return wide.mapInArrow(run, "a long, b long")


def _of(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows that stand in some stored pair: only they are exchanged."""
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct()
    return rows.join(materialise(ends), "rep", "left_semi")


def _tag(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A digest of each set: the sum of its mixed elements."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets * np.uint64(3)))])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)


def _centres(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, centre): the shingles that more than half of a group's members hold, by DRAWN drawn members at most."""

    def run(part: pa.Table) -> pa.Table:
        held = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("hashes")]
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.table({"key": part.column("key").slice(0, 1), "centre": pa.array([values[2 * counts > len(held)].tobytes()], pa.binary())})

    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("rep"), "rep"))
    drawn = materialise(groups.select("key", "rep").withColumn("place", place).filter(F.col("place") <= DRAWN).select("key", "rep"))
    return drawn.join(sets, "rep").select("key", "hashes").groupBy("key").applyInArrow(run, "key long, centre binary")


def _differences(members: DataFrame, percent: int) -> DataFrame:
    """(key, rep, hashes, centre) to key, rep, tag of the set, its distance from the centre (`d`), the elements that one of both holds (`diff`), and the excess
    `s` = (100 + percent) * d - (100 - percent) * size, so that two sets are linked if 2 * (100 + percent) * shared elements of their differences >= the sum of their excesses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                own, centre = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in (2, 3))
                diff = np.setxor1d(own, centre, assume_unique=True)
                excess = (100 + percent) * len(diff) - (100 - percent) * len(own)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array(_tag(own, np.array([0, len(own)]))), pa.array([len(diff)], pa.int64()),
                    pa.array([excess], pa.int64()), pa.array([diff.view(np.int64)], pa.list_(pa.int64())),
                ], names=["key", "rep", "tag", "d", "s", "diff"])

    return members.mapInArrow(run, "key long, rep long, tag long, d long, s long, diff array<long>")


def _split(groups: DataFrame, sets: DataFrame, reps: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links within groups (key, rep), and smaller groups (key, rep, lead): any linked pair that those links do not join stands in one of them, with `lead` in one row at least.

    A group has a centre, any set. Members whose excesses sum to 0 or less are linked whatever they share, so those that are so with the least excess are one core. Every pair with a member outside shares
    differences from the centre, in number at least the sum of the two excesses over 2 * (100 + percent). So it shares one of as many of the rarest differences as each can lack, and one more; the one with
    the smaller excess (`lead`) can lack fewer, since the other's is no smaller. Copies of one text differ from their centre in few shingles, mostly each in its own: a large group of them costs rows as its members.
    """
    sizes = groups.groupBy("key").agg(F.ceil(F.count("*") / SPREAD).cast("long").alias("parts"))
    centres = materialise(_centres(groups, sets).join(sizes, "key").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))))
    # stored while narrow, so that sets are exchanged only where the members are too many to be sent to them
    members = materialise(groups.select("key", "rep").join(sizes, "key").select("key", "rep", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part")))
    away = _differences(members.join(sets, "rep").join(centres.select("key", "part", "centre"), ["key", "part"]).select("key", "rep", "hashes", "centre"), percent)
    # an id may stand in several rows: only the texts that stand for their class, once
    away = materialise(away.join(reps.select("rep", F.col("d1").alias("tag")), ["rep", "tag"], "left_semi").dropDuplicates(["key", "rep", "tag"]))
    best = materialise(away.groupBy("key").agg(F.min(F.struct("s", "rep")).alias("best")))
    placed = away.join(best, "key").withColumn("core", F.col("s") + F.col("best.s") <= 0)
    links = placed.filter("core AND rep <> best.rep").select(F.col("best.rep").alias("a"), F.col("rep").alias("b")).distinct()
    outside = placed.filter("NOT core").groupBy("key").agg(F.min("s").alias("next"))
    # places that an element shared with a set of this excess or more can take at the latest
    last = lambda other: F.col("d") - F.greatest(F.lit(1), F.ceil((F.col("s") + other) / (2 * (100 + percent)))).cast("long") + 1
    rows = materialise(
        placed.join(outside, "key").withColumn("lead", last(F.when(F.col("core"), F.col("next")).otherwise(F.greatest("s", "best.s"))))
        .withColumn("last", F.when(F.col("core"), F.col("lead")).otherwise(last(F.col("best.s")))).filter("last > 0")
        .select("key", "rep", "tag", "core", "d", "lead", "last", F.explode("diff").alias("element"))
    )
    # elements that can make no pair come first, then the rarest
    useful = rows.groupBy("key", "element").agg(F.count("*").alias("held"), F.bool_and("core").alias("inside")).filter("held > 1 AND NOT inside").drop("inside")
    own = Window.partitionBy("key", "rep", "tag")
    place = F.col("d") - F.count("*").over(own) + F.row_number().over(own.orderBy("held", "element"))
    led = rows.join(useful, ["key", "element"]).withColumn("place", place).filter("place <= last")
    return links, led.groupBy(F.xxhash64("key", "element").alias("key"), "rep").agg(F.bool_or(F.col("place") <= F.col("lead")).alias("lead"))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (rep, c) after new links: components of the components."""
    if links.isEmpty():
        return labels
    ends = links.join(labels.withColumnsRenamed({"rep": "a", "c": "u"}), "a").join(labels.withColumnsRenamed({"rep": "b", "c": "v"}), "b")
    moved = components(ends.select(F.col("u").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct())
    return materialise(
        labels.join(moved.withColumnRenamed("id", "c"), "c", "left").select("rep", F.coalesce("component", "c").alias("c"))
    )


def _open(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, rep, lead, c, n): the groups whose members are in several components, of those with the same members one."""
    placed = groups.join(labels, "rep")
    several = placed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high"),
        F.bit_xor(F.xxhash64("rep", "lead")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "rep", "lead")).alias("y"), F.bool_or("lead").alias("some"),
    ).filter("low < high AND some")
    one = several.groupBy("n", "low", "high", "x", "y").agg(F.min("key").alias("key")).select("key", "n")
    return materialise(placed.join(one, "key").select("key", "rep", "lead", "c", "n"))


def _pairs(groups: DataFrame) -> DataFrame:
    """All pairs (a, b) of a group whose members are in different components, one of them with `lead`; large groups in blocks."""
    rows = groups.withColumn("blocks", F.ceil(F.col("n") / 512).cast("long"))
    left = rows.select("key", F.col("rep").alias("x"), F.col("c").alias("cx"), F.col("lead").alias("lx"), F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("block"))
    right = rows.select("key", F.col("rep").alias("y"), F.col("c").alias("cy"), F.col("lead").alias("ly"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    return left.join(right, ["key", "block"]).filter("x < y AND cx <> cy AND (lx OR ly)").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def near_copies(docs: DataFrame, size: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: id, n_shingles, component_id (least id reachable over links), kept (it is that id).

    Two documents are linked if 100 * intersection >= percent * union of their sets of `size`-word shingles; a text with
    fewer words gives its whole sequence, one without words (or null) an empty set that links with nothing. Rows that
    share an id take the least component of their texts. A row without id is linked with nothing, has no component and is kept.

    Documents with the same set are one class; only its least id is compared. Classes that are connected over shared bands are one group. In groups of a few, all pairs are compared. In larger ones each
    set is compared with a centre, which links those near it, and the others fall into smaller groups by their differences from it (`_split`). What is still in several components after MOST_SPLITS turns is
    compared pair by pair, so no link between components is left out. Pairs are thinned by the likelihood estimate and decided on the full sets.
    """
    rows, bands = band_plan(percent / 100)
    least = percent / 100
    base = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    drawn = materialise(sketch(base, size, rows, bands))
    some = drawn.filter("n_shingles > 0 AND id IS NOT NULL")
    classes = materialise(some.groupBy("d1", "d2", "n_shingles").agg(F.min("id").alias("rep")))
    reps = materialise(
        some.join(classes.select(F.col("rep").alias("id"), "d1", "d2", "n_shingles"), ["id", "d1", "d2", "n_shingles"], "left_semi")
        .dropDuplicates(["id", "d1", "d2", "n_shingles"]).select(F.col("id").alias("rep"), "n_shingles", "registers", "bands", "d1")
    )
    banded = reps.select("rep", F.explode("bands").alias("key"))
    met = banded.groupBy("key").agg(F.min("rep").alias("a"), F.count("*").alias("n")).filter("n > 1")
    shared = materialise(banded.join(met, "key").select("a", F.col("rep").alias("b")).distinct())
    meant = materialise(shared.select(F.col("b").alias("rep")).distinct())
    sets = materialise(_full_sets(base.join(meant.withColumnRenamed("rep", "id"), "id", "left_semi"), size))

    def checked(pairs: DataFrame) -> DataFrame:
        pairs = materialise(pairs)
        likely = materialise(_likely(pairs, _of(reps, pairs), least))
        return materialise(_verified(likely, _of(sets, likely), percent))

    labels = meant.withColumn("c", F.col("rep"))
    groups = materialise(components(shared).select(F.col("component").alias("key"), F.col("id").alias("rep"), F.lit(True).alias("lead")))
    for turn in range(MOST_SPLITS + 1):
        groups = _open(groups, labels)
        few = F.col("n") <= FEW * 4**turn if turn < MOST_SPLITS else F.lit(True)
        labels = _joined(labels, checked(_pairs(groups.filter(few))))
        large = groups.filter(~few)
        if large.isEmpty():
            break
        links, finer = _split(large, sets, reps, percent)
        labels, groups = _joined(labels, materialise(links)), materialise(finer)
    named = (
        some.join(classes, ["d1", "d2", "n_shingles"]).join(labels, "rep", "left")
        .groupBy("id").agg(F.min(F.coalesce("c", "rep")).alias("component"))
    )
    return (
        drawn.select("id", "n_shingles").join(named, "id", "left")
        .select(F.col("id").alias(id), "n_shingles", F.coalesce("component", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True)))
    )


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets, bounds in _sets(batch, 1, size):
                n = len(bounds) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array([sets[bounds[i] : bounds[i + 1]].tobytes() for i in range(n)], pa.binary())],
                    names=["rep", "hashes"],
                )

    return docs.mapInArrow(run, "rep long, hashes binary")
