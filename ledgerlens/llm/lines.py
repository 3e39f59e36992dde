"""Repeated multi-line chunks: content-defined boundaries over line hashes, global counts, byte comparison, removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialise

DIVISOR = 3
FACTORS = (5, 7)
OLD_FACTORS = (3, 5)
ADDED = ("n_lines", "n_removed_lines", "n_removed_chunks")


def with_chunks(docs: DataFrame, text: str, factors: tuple[int, int] = OLD_FACTORS) -> DataFrame:
    """Adds `__chunks`: (place, lines, body) of each chunk of the text; a null text has none.

    A line ends a chunk if the rolling hash f * v + g * w of its hash v and that of the line before, w (0 before the first line), is divisible by
    DIVISOR: boundaries follow the content, so an inserted line moves them nowhere else. The last line ends the last chunk. With factors
    prime to DIVISOR (FACTORS) both lines decide; with OLD_FACTORS only the line before does, and line 1 always ends a chunk.
    """
    number = "CAST(conv(substr(md5(x), 1, 8), 16, 10) AS BIGINT)"
    from_line = "CASE WHEN k = 0 THEN 1 ELSE es[k - 1] + 2 END"
    count = "CASE WHEN k = 0 THEN e + 1 ELSE e - es[k - 1] END"
    roll = f"{factors[0]} * hs[i] + CASE WHEN i = 0 THEN 0 ELSE {factors[1]} * hs[i - 1] END"
    # one-element arrays bind a value once: a plain column used inside a lambda would be computed for each element
    ends = f"filter(sequence(0, size(ls) - 1), i -> i = size(ls) - 1 OR pmod({roll}, {DIVISOR}) = 0)"
    pieces = f"transform(es, (e, k) -> struct(k AS place, {count} AS lines, array_join(slice(ls, {from_line}, {count}), '\\n') AS body))"
    bound = (
        f"transform(array(split(`{text}`, '\\n', -1)), ls -> transform(array(transform(ls, x -> {number})), hs -> "
        f"transform(array({ends}), es -> {pieces})[0])[0])[0]"
    )
    return docs.selectExpr("*", f"CASE WHEN `{text}` IS NOT NULL THEN {bound} END AS __chunks")


def drop_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", factors: tuple[int, int] = OLD_FACTORS) -> DataFrame:
    """Every row, with each multi-line chunk that stands elsewhere too removed but for its first place (least id, then place).

    Columns are kept, `text` is what remains, and `n_lines`, `n_removed_lines`, `n_removed_chunks` are added (replacing
    columns of these names). A null text stays null and has no line; a text whose chunks all go becomes empty. Chunks of
    one line are never removed. Rows that share an id stand for one document, as do all rows without id.
    `factors` set the boundaries, see `with_chunks`. Hashes only propose: a chunk goes if its bytes equal those of the first place.
    """
    named = docs.drop(*ADDED).withColumn("__key", F.coalesce(F.col(id).cast("string"), F.lit("")))
    pieces = with_chunks(named.select("__key", F.col(text).alias("__text")), "__text", factors).selectExpr("__key", "inline(__chunks)").filter("lines > 1")
    order = F.struct(F.expr("try_cast(__key AS BIGINT)").alias("n"), "__key", "place")
    hashed = pieces.select("__key", "place", "body", F.xxhash64("body").alias("h"), F.hash("body").alias("g"), F.length("body").alias("size"))
    met = (
        hashed.groupBy("h", "g", "size").agg(F.count("*").alias("n"), F.min(order).alias("first"))
        .filter("n > 1").selectExpr("h", "g", "size", "first.__key AS first_key", "first.place AS first_place")
    )
    found = materialise(hashed.join(met, ["h", "g", "size"]))
    head = found.filter("__key = first_key AND place = first_place").select("h", "g", "size", F.col("body").alias("head")).dropDuplicates(["h", "g", "size"])
    gone = (
        found.filter("NOT (__key = first_key AND place = first_place)").join(head, ["h", "g", "size"]).filter("body = head")
        .groupBy("__key").agg(F.collect_set("place").alias("__gone"))
    )
    cut = with_chunks(named.join(gone, "__key", "left"), text, factors)
    dropped = "filter(__chunks, c -> array_contains(__gone, c.place))"
    rest = "array_join(transform(filter(__chunks, c -> NOT array_contains(__gone, c.place)), c -> c.body), '\\n')"
    plain = [f"CASE WHEN __gone IS NULL THEN `{text}` ELSE {rest} END AS `{text}`" if c == text else f"`{c}`" for c in docs.columns if c not in ADDED]
    return cut.selectExpr(
        *plain, "CAST(coalesce(aggregate(__chunks, 0, (n, c) -> n + c.lines), 0) AS BIGINT) AS n_lines",
        f"CAST(CASE WHEN __gone IS NULL THEN 0 ELSE aggregate({dropped}, 0, (n, c) -> n + c.lines) END AS BIGINT) AS n_removed_lines",
        f"CAST(CASE WHEN __gone IS NULL THEN 0 ELSE size({dropped}) END AS BIGINT) AS n_removed_chunks",
    )


def drop_repeated_passages(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row, without the lines of each passage of two or more lines that stands at an earlier place too (in the order of ids, then places).

    A passage is found wherever it begins and whatever surrounds it: two neighbouring lines go if the same two lines stand together
    before, in this or another document. A lone repeated line stays, as do two neighbouring lines of white space. Of
    every line that goes an equal one is kept. Columns are kept, `text` is what remains, and `n_lines` and `n_removed_lines` are added
    (replacing columns of these names). A null text stays null and has no line; a text whose lines all go becomes empty. Rows with
    the same id and text stand for one document; other rows that share an id, or have none, are documents of their own.
    Pairs of lines are known by their SHA-256.
    """
    added = ("n_lines", "n_removed_lines")
    document = ["__key", "__x", "__y"]
    named = docs.drop(*added).withColumns({
        "__key": F.coalesce(F.col(id).cast("string"), F.lit("")), "__x": F.xxhash64(F.col(id).isNull(), text), "__y": F.hash(text),
    })
    split = f"split(`{text}`, '\n', -1)"
    blank = "trim(BOTH ' \\t\\r' FROM ls[{}]) = ''"
    pair = f"CASE WHEN NOT ({blank.format('i')} AND {blank.format('i + 1')}) THEN unhex(sha2(concat(ls[i], '\n', ls[i + 1]), 256)) END"
    pairs = f"transform(array({split}), ls -> IF(size(ls) < 2, array(), transform(sequence(0, size(ls) - 2), i -> {pair})))[0]"
    hashed = named.filter(F.col(text).isNotNull()).selectExpr(*document, f"posexplode({pairs}) AS (place, pair)").filter("pair IS NOT NULL")
    order = F.struct(F.expr("try_cast(__key AS BIGINT)").alias("n"), *document, "place")
    # written first: a join of two plain shuffles is one whose hot pairs Spark splits
    met = materialise(hashed.groupBy("pair").agg(F.count("*").alias("n"), F.min(order).alias("first")).filter("n > 1").select("pair", "first"))
    gone = (
        hashed.join(met, "pair").filter(" OR ".join(f"{c} <> first.{c}" for c in [*document, "place"]))
        .groupBy(*document).agg(F.collect_set("place").alias("__places"))
        .select(*document, F.expr("array_union(__places, transform(__places, p -> p + 1))").alias("__gone"))
    )
    left = f"transform(array({split}), ls -> array_join(transform(array_except(sequence(0, size(ls) - 1), __gone), i -> ls[i]), '\n'))[0]"
    plain = [f"CASE WHEN __gone IS NULL THEN `{text}` ELSE {left} END AS `{text}`" if c == text else f"`{c}`" for c in docs.columns if c not in added]
    return named.join(gone, document, "left").selectExpr(
        *plain, f"CAST(CASE WHEN `{text}` IS NULL THEN 0 ELSE size({split}) END AS BIGINT) AS n_lines",
        "CAST(CASE WHEN __gone IS NULL THEN 0 ELSE size(__gone) END AS BIGINT) AS n_removed_lines",
    )


ORACLE = """
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i, len(ls) - 1 AS last_i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
v AS (SELECT *, CAST('0x' || left(md5(line), 8) AS BIGINT) AS cur FROM l),
p AS (SELECT *, coalesce(lag(cur) OVER (PARTITION BY doc_id ORDER BY i), 0) AS prev FROM v),
b AS (SELECT *, i = last_i OR (5 * cur + 7 * prev) % 3 = 0 AS ends FROM p),
n AS (SELECT *, count(*) FILTER (WHERE ends) OVER (PARTITION BY doc_id ORDER BY i) - ends::INT AS place FROM b),
k AS (SELECT doc_id, place, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS body FROM n GROUP BY doc_id, place),
r AS (SELECT *, (lines > 1 AND row_number() OVER (PARTITION BY body ORDER BY doc_id, place) > 1)::INT AS gone FROM k)
SELECT doc_id, CAST(coalesce(sum(lines) FILTER (WHERE body IS NOT NULL), 0) AS BIGINT) AS n_lines, CAST(sum(lines * gone) AS BIGINT) AS n_removed_lines,
  CAST(sum(gone) AS BIGINT) AS n_removed_chunks,
  sha256(coalesce(string_agg(body, chr(10) ORDER BY place) FILTER (WHERE gone = 0), '')) AS kept_sha256
FROM r GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, 0, sha256('') FROM documents WHERE text IS NULL
"""
