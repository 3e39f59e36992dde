"""SimHash fingerprints in SQL: weighted term hashes vote on signed bits; permuted block tables find near fingerprints."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialise

HALVES = 2  # 64-bit hashes a term: 128 bits
LANES = 0x0000000100000001
BLOCK_ROWS = 512


def _terms(text: str) -> str:
    """Hash pairs and weights of the terms of a text: neighbouring words (one word alone if there are no two), longer ones weigh more."""
    pair = (
        "transform(sequence(0, greatest(size(ws) - 2, 0)), i -> named_struct("
        "'a', xxhash64(ws[i], get(ws, i + 1)), 'b', xxhash64(get(ws, i + 1), ws[i], 7), "
        "'w', CAST(least(length(ws[i]) + coalesce(length(get(ws, i + 1)), 0), 16) AS BIGINT)))"
    )
    return f"transform(array(filter(split({text}, '[ \\\\t-\\\\r]+'), w -> w <> '')), ws -> IF(size(ws) = 0, array(), {pair}))[0]"


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, f0, f1: the two halves of the fingerprint of every whole text, one row for each distinct key.

    Each term adds its weight to the bits its hash has set; a bit of the fingerprint is set if it has more than half of the
    whole weight. Null counts as empty, and empty texts have all bits unset. The sums of a text are made in the task that
    reads it and merged by key, so neither long texts nor repeated keys gather anywhere. Two bits share a 64-bit sum.
    """
    exploded = docs.select(*keys, F.explode_outer(F.expr(_terms(f"coalesce(`{text}`, '')"))).alias("t")).select(*keys, "t.*")
    sums = [
        F.sum((F.shiftrightunsigned(F.col(c), k).bitwiseAND(F.lit(LANES))) * F.col("w")).alias(f"{c}{k}") for c in ("a", "b") for k in range(32)
    ]
    voted = exploded.groupBy(*keys).agg(F.coalesce(F.sum("w"), F.lit(0)).alias("whole"), *sums)

    def half(c: str) -> Column:
        parts = []
        for k in range(32):
            low, high = F.col(f"{c}{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"{c}{k}"), 32)
            parts.append(F.when(low * 2 > F.col("whole"), F.lit(1 << k)).otherwise(F.lit(0)))
            high_bit = (1 << (k + 32)) if k < 31 else -(1 << 63)
            parts.append(F.when(high * 2 > F.col("whole"), F.lit(high_bit)).otherwise(F.lit(0)))
        out = parts[0]
        for p in parts[1:]:
            out = out.bitwiseOR(p)
        return out.cast("long")

    return voted.select(*keys, half("a").alias("f0"), half("b").alias("f1"))


def spelled(a: str, b: str) -> Column:
    """The fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def distance(a0: str, a1: str, b0: str, b1: str) -> Column:
    return F.bit_count(F.col(a0).bitwiseXOR(F.col(b0))) + F.bit_count(F.col(a1).bitwiseXOR(F.col(b1)))


def likeness(a0: str, a1: str, b0: str, b1: str) -> Column:
    """Cosine of the term vectors as the fingerprints tell it, from 0 to 1; equal fingerprints give 1."""
    return F.greatest(F.lit(0.0), F.cos(distance(a0, a1, b0, b1) * F.lit(math.pi / (64 * HALVES))))


def next_ids(ids: DataFrame, id: str) -> DataFrame:
    """Every distinct id with the next larger one; the largest is followed by the least.

    Ids are sorted by a range shuffle; each part looks within itself, and only the least id of each part is compared across parts.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(ids.filter(F.col(id).isNotNull()).select(id).distinct().repartitionByRange(parts, id).withColumn("part", F.spark_partition_id()))
    heads = placed.groupBy("part").agg(F.min(id).alias("head"))
    # one row for each part of the range shuffle
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    after = heads.select("part", F.coalesce(F.lead("head").over(order), F.min("head").over(Window.partitionBy(F.lit(0)))).alias("after"))
    inside = placed.withColumn("next", F.lead(id).over(Window.partitionBy("part").orderBy(id)))
    return inside.join(F.broadcast(after), "part").select(id, F.coalesce("next", "after").alias("next_id"))


def with_edited(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, next_id, text, edited: the last quarter (code points, rounded down) replaced by as many of the next text, or all of it.

    Null texts count as empty. Where an id is repeated, the next text is the least of its texts. A row without id has no next one:
    its last quarter goes.
    """
    plain = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    known = plain.filter("id IS NOT NULL")
    sized = known.select("id", (F.length("text") / 4).cast("long").alias("quarter"))
    order = next_ids(known, "id")
    wanted = (
        order.join(sized.groupBy("id").agg(F.max("quarter").alias("quarter")), "id")
        .groupBy(F.col("next_id").alias("id")).agg(F.min("id").alias("prev_id"), F.max("quarter").alias("need"))
    )
    # texts are shuffled by id once: for their heads, which go to the row before, and for themselves
    linked = known.join(materialise(order.join(wanted, "id")), "id")
    heads = linked.select(F.col("prev_id").alias("id"), F.expr("left(text, CAST(need AS INT))").alias("head")).groupBy("id").agg(F.min("head").alias("head"))
    whole = linked.join(heads, "id", "left").select("id", "next_id", "text", "head").unionByName(
        plain.filter("id IS NULL").select("id", "text"), allowMissingColumns=True
    )
    quarter = "CAST(floor(length(text) / 4) AS INT)"
    return whole.select(
        "id", "next_id", "text",
        F.expr(f"concat(left(text, length(text) - {quarter}), left(coalesce(head, ''), {quarter}))").alias("edited"),
    )


def fingerprint_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: fingerprints of the text and the edited text, and likeness to the edited and to the next text."""
    both = with_edited(docs, id, text)
    rows = both.select(
        "id", "next_id", F.length("text").cast("long").alias("n_chars"), F.xxhash64("text").alias("h"), F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")))).alias("x"),
    ).select("id", "next_id", "n_chars", "h", "edited_sha256", "x.kind", "x.t")
    made = materialise(fingerprints(rows, ["id", "next_id", "n_chars", "h", "edited_sha256", "kind"], "t"))
    wide = made.groupBy("id", "next_id", "n_chars", "h", "edited_sha256").agg(
        *[F.max(F.when(F.col("kind") == k, F.col(f))).alias(f"{n}{f}") for k, n in ((0, "own_"), (1, "edited_")) for f in ("f0", "f1")]
    )
    following = made.filter("kind = 0").groupBy(F.col("id").alias("next_id")).agg(F.min(F.struct("f0", "f1")).alias("n")).select("next_id", "n.f0", "n.f1")
    return wide.join(following, "next_id", "left").select(
        F.col("id").alias(id), "n_chars", "edited_sha256", spelled("own_f0", "own_f1").alias("fingerprint"), spelled("edited_f0", "edited_f1").alias("edited_fingerprint"),
        likeness("own_f0", "own_f1", "edited_f0", "edited_f1").alias("near_edited"),
        F.coalesce(likeness("own_f0", "own_f1", "f0", "f1"), F.lit(0.0)).alias("near_next"),
    )


def near_fingerprints(marked: DataFrame, radius: int = 3, blocks: int = 4) -> DataFrame:
    """All pairs of distinct fingerprints (columns a0, a1, b0, b1, distance) at most `radius` bits apart, each pair once.

    The bits are cut into `blocks` blocks; within the radius at least blocks - radius of them agree. For each choice of so many blocks, one
    table is keyed by them, so every such pair meets in a table. Input rows with the same fingerprint are one; large buckets are
    joined in slices of BLOCK_ROWS rows.
    """
    if blocks <= radius or 32 % blocks:
        raise ValueError("blocks must divide 32 and be more than the radius")
    width = 32 // blocks
    distinct = marked.select("f0", "f1").distinct().withColumn("s", spelled("f0", "f1"))
    keys = [
        F.concat(F.lit(f"{n}:"), *[F.substring("s", 1 + width * b, width) for b in chosen])
        for n, chosen in enumerate(combinations(range(blocks), blocks - radius))
    ]
    rows = materialise(distinct.select("f0", "f1", F.explode(F.array(*keys)).alias("key")))
    sized = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").withColumn("slices", F.ceil(F.col("n") / BLOCK_ROWS))
    met = rows.join(sized, "key")
    left = met.select("key", F.col("f0").alias("a0"), F.col("f1").alias("a1"), F.pmod(F.xxhash64("f0", "f1"), F.col("slices")).alias("slice"))
    right = met.select("key", F.col("f0").alias("b0"), F.col("f1").alias("b1"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    return (
        left.join(right, ["key", "slice"]).filter("a0 < b0 OR a0 = b0 AND a1 < b1").select("a0", "a1", "b0", "b1", distance("a0", "a1", "b0", "b1").alias("distance"))
        .filter(F.col("distance") <= radius).distinct()
    )
