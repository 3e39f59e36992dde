"""Sharding by balanced label propagation: linked documents move towards their neighbours' shards under capacity quotas, free ones fill the gaps."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.skew import DEFAULT_POLICY, SkewPolicy, skewed_lookup
from ledgerlens.session import materialise

BUCKET_ROWS = 20_000  # rows numbered by one window group
ORDERS = 256          # groups of hubs let in one after another where a quota binds
VOTES = 4             # shards that a hub votes for at once
HEAVY = 8             # hubs above an eighth of a shard, HEAVY * shards at most, are placed before the rest


def text_items(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row a row of `docs`: `item` (a number of its own), the kept columns, `size`, `text_crc32` and `hub`, written out so that numbers stay.

    A size is the text's UTF-8 bytes plus 16. Equal texts share a hub, a 128-bit digest; null counts as the empty text. Repeated rows and rows
    without id are items of their own.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return materialise(docs.select(
        F.monotonically_increasing_id().alias("item"), *[F.col(c) for c in keep], (F.octet_length(body) + 16).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"), F.unhex(F.substring(F.sha2(body, 256), 1, 32)).alias("hub"),
    ))


def _hash(*columns) -> Column:
    """A number from 0 to below 2^31, alike at every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 31))


def _interval(edges: list[float], value: Column) -> Column:
    """Number of edges at or below the value, as an int: which of the consecutive intervals it falls into."""
    marks = F.array(*[F.lit(float(e)) for e in edges]).cast("array<double>")
    return F.least(F.size(F.filter(marks, lambda e: e <= value)), F.lit(len(edges) - 1)).cast("int")


def _with_hubs(links: DataFrame, hubs: DataFrame, total: int) -> DataFrame:
    """Links with the columns of their hub; hubs above a five-hundredth of the links are looked up apart, so none is one task's load."""
    policy: SkewPolicy = replace(DEFAULT_POLICY, hot_rows=max(1000, total // 500))
    return skewed_lookup(links, hubs, ["hub"], "members", total, "item", policy)


def level(loads: list[float], amount: float) -> list[float]:
    """What each shard takes of `amount` so that the least loaded end equally high."""
    height, taken = 0.0, 0.0
    for k, load in enumerate(sorted(loads)):
        if k and k * (load - height) >= amount - taken:
            break
        taken += k * (load - height) if k else 0.0
        height = load
    filled = sum(load <= height for load in loads)
    height += (amount - taken) / filled
    return [max(0.0, height - load) for load in loads]


def quotas(asked: dict[tuple[int, int], int], loads: list[int], capacity: float) -> dict[tuple[int, int], float]:
    """Bytes let from shard to shard: what two shards would exchange, and each one's free room in proportion to what is asked beyond that."""
    swapped = {(i, j): min(v, asked.get((j, i), 0)) for (i, j), v in asked.items()}
    beyond = [0] * len(loads)
    for (i, j), v in asked.items():
        beyond[j] += v - swapped[i, j]
    share = [min(1.0, max(0.0, capacity - load) / b) if b else 0.0 for load, b in zip(loads, beyond)]
    return {(i, j): swapped[i, j] + share[j] * (v - swapped[i, j]) for (i, j), v in asked.items()}


def _loads(labels: DataFrame, shards: int) -> list[int]:
    out = [0] * shards
    for r in labels.groupBy("shard").agg(F.sum("size").alias("b")).collect():  # one row a shard
        out[r["shard"]] = r["b"]
    return out


def _linked(items: DataFrame, links: DataFrame, capacity: float) -> tuple[DataFrame, DataFrame, int] | None:
    """Links (item, hub, size) of hubs with two items or more, the hubs (members, bytes) and the number of links.

    A hub with more bytes than a shard holds cannot stay whole: it is split into as many hubs as shards it needs, by a hash of the items.
    """
    pairs = materialise(links.select("item", "hub").where("hub IS NOT NULL").distinct().join(items.select("item", "size"), "item"))
    hubs = materialise(pairs.groupBy("hub").agg(F.count("*").alias("members"), F.sum("size").alias("bytes")).where("members > 1"))
    total = hubs.agg(F.sum("members")).first()[0]
    if not total:
        return None
    parts = F.ceil(F.col("bytes") / F.lit(capacity)).cast("bigint")
    part = F.when(parts > 1, F.pmod(F.xxhash64("item"), parts)).otherwise(0)
    split = materialise(
        _with_hubs(pairs, hubs, pairs.count()).where("members IS NOT NULL").select("item", F.xxhash64("hub", part).alias("hub"), "size")
    )
    hubs = split.groupBy("hub").agg(F.count("*").alias("members"), F.sum("size").alias("bytes"))
    return split, materialise(hubs), total


def _first_labels(links: DataFrame, hubs: DataFrame, total: int, shards: int, capacity: float) -> DataFrame:
    """Where label propagation starts: heavy hubs together, largest first, on the least loaded shard; other items by a hash, in proportion to the room left."""
    loads, seats = [0.0] * shards, {}
    heavy = hubs.where(F.col("bytes") > F.lit(capacity / HEAVY)).orderBy(F.desc("bytes"), "hub").collect()  # HEAVY * shards * hubs per item at most
    for r in heavy:
        s = loads.index(min(loads))
        seats[r["hub"]], loads[s] = s, loads[s] + r["bytes"]
    room = [max(capacity - load, capacity * 0.01) for load in loads]
    edges, upto = [], 0.0
    for v in room:
        upto += v
        edges.append(upto / sum(room))
    drawn = _interval(edges, _hash("item") / F.lit(float(1 << 31)))
    if not seats:
        return links.groupBy("item").agg(F.first("size").alias("size"), F.min("hub").alias("team")).withColumn("shard", drawn)
    spark = links.sparkSession
    seated = F.broadcast(spark.createDataFrame(list(seats.items()), "hub bigint, seat int"))
    first = links.join(seated, "hub", "left").groupBy("item").agg(F.first("size").alias("size"), F.min("hub").alias("team"), F.min("seat").alias("seat"))
    return first.select("item", "size", "team", F.coalesce("seat", drawn).alias("shard"))


def _propagated(links: DataFrame, hubs: DataFrame, total: int, shards: int, capacity: float, rounds: int) -> DataFrame:
    """Labels (item, size, team, shard) of linked items after rounds of moves; ends early when nobody moves."""
    labels = materialise(_first_labels(links, hubs, total, shards, capacity))
    for k in range(rounds):
        loads = _loads(labels, shards)
        room = F.array(*[F.lit(float(capacity - load)) for load in loads])
        seen = links.select("item", "hub").join(labels.drop("team"), "item")
        # a hub votes for the shards with most of its bytes that hold or can take the rest of it; if none can, for one drawn anew each round
        pieces = seen.groupBy("hub", "shard").agg(F.sum("size").alias("here")).join(hubs, "hub")
        fits = (F.col("here") == F.col("bytes")) | (F.get(room, F.col("shard")) >= F.col("bytes") - F.col("here"))
        ranked = F.sort_array(F.collect_list(F.struct(fits.alias("fits"), "here", _hash("hub", "shard").alias("tie"), F.col("shard").alias("vote"))), asc=False)
        drawn = F.array(F.struct(F.pmod(_hash("hub", F.lit(k)), F.lit(shards)).cast("int").alias("vote"), F.lit(0).cast("bigint").alias("here")))
        best = F.transform(F.slice(F.filter("ranked", lambda v: v["fits"]), 1, VOTES), lambda v: F.struct(v["vote"].alias("vote"), v["here"].alias("here")))
        votes = (
            pieces.groupBy("hub").agg(F.first("members").alias("members"), F.first("bytes").alias("bytes"), ranked.alias("ranked"))
            .select("hub", "members", "bytes", F.when(F.size(best) > 0, best).otherwise(drawn).alias("votes"))
        )
        # an item goes where most of its hubs want to be, then where they have the largest share beside itself, and stays on a tie; without
        # the first rule the items of a pair would change places for ever
        ballots = _with_hubs(seen, materialise(votes), total).select("item", "size", "shard", "hub", "bytes", F.posexplode("votes").alias("rank", "v")).select("*", "v.*")
        others = F.col("here") - F.when(F.col("vote") == F.col("shard"), F.col("size")).otherwise(0)
        weight = F.round(F.sum((F.col("rank") == 0).cast("int") + F.greatest(others / F.col("bytes"), F.lit(1e-6))), 9)
        counted = ballots.groupBy("item", "size", "shard", "vote").agg(weight.alias("n"), F.min(_hash("hub", F.lit(k))).alias("order"))
        choice = F.max(F.struct("n", (F.col("vote") == F.col("shard")).alias("stay"), (-F.col("order")).alias("order"), "vote")).alias("c")
        movers = materialise(
            counted.groupBy("item", "size", "shard").agg(choice).where("c.vote <> shard")
            .select("item", "size", F.col("shard").alias("source"), F.col("c.vote").alias("goal"), F.pmod(-F.col("c.order"), F.lit(ORDERS)).cast("int").alias("turn"))
        )
        flows = movers.groupBy("source", "goal", "turn").agg(F.sum("size").alias("b"))
        asked = {(r["source"], r["goal"]): r["b"] for r in flows.groupBy("source", "goal").agg(F.sum("b").alias("b")).collect()}  # shards^2 rows at most
        if not asked:
            break
        allowed = quotas(asked, loads, capacity)
        limits = F.broadcast(links.sparkSession.createDataFrame([(i, j, float(v)) for (i, j), v in allowed.items()], "source int, goal int, quota double"))
        # the whole of a hub has one turn, so hubs move together; turns are let in while more than half of them is within the quota
        upto = F.sum("b").over(Window.partitionBy("source", "goal").orderBy("turn"))
        let = flows.join(limits, ["source", "goal"]).select("source", "goal", "turn", (upto - F.col("b") / 2 <= F.col("quota")).alias("let")).where("let")
        moved = movers.join(F.broadcast(let), ["source", "goal", "turn"]).select("item", "goal")  # shards^2 * ORDERS small rows at most
        after = materialise(labels.join(moved, "item", "left").select("item", "size", "team", F.coalesce("goal", "shard").alias("shard"), F.col("goal").isNotNull().alias("moved")))
        labels = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    return labels


def _relieved(labels: DataFrame, shards: int, capacity: float) -> tuple[DataFrame, DataFrame | None]:
    """Labels within the capacity of each shard, and what overfull shards give up (item, size, unit); None where no shard is overfull.

    Items of one hub in one shard are one unit and stay together, unless they are more than a sixty-fourth of a shard.
    """
    loads = _loads(labels, shards)
    if max(loads) <= capacity:
        return labels, None
    teams = labels.groupBy("shard", "team").agg(F.sum("size").alias("b"))
    few = materialise(teams.where(F.col("b") <= capacity / 64).select("shard", "team", F.concat_ws("-", F.lit("team"), "shard", "team").alias("unit")))
    parted = labels.join(few, ["shard", "team"], "left").withColumn("unit", F.coalesce("unit", F.col("item").cast("string")))
    turned = materialise(parted.withColumn("turn", F.pmod(_hash("unit"), F.lit(4 * ORDERS)).cast("int")))
    upto = F.sum("b").over(Window.partitionBy("shard").orderBy("turn"))
    stay = turned.groupBy("shard", "turn").agg(F.sum("size").alias("b")).select("shard", "turn", (upto <= F.lit(capacity)).alias("stay")).where("stay").drop("stay")
    stay = F.broadcast(stay)  # 4 * ORDERS * shards small rows at most
    kept = turned.join(stay, ["shard", "turn"], "left_semi").select("item", "size", "shard", "team")
    return kept, turned.join(stay, ["shard", "turn"], "left_anti").select("item", "size", "unit")


def _filled(free: DataFrame, loads: list[int], shards: int) -> DataFrame:
    """Shards (item, shard) of free items: size classes from the largest down, each poured so that the least loaded shards end equally high."""
    rows = free.count()
    buckets = max(1, math.ceil(rows / BUCKET_ROWS))
    sized = free.select("item", "size", F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int").alias("kind"), F.pmod(F.xxhash64("item"), F.lit(buckets)).alias("bucket"))
    earlier = Window.partitionBy("kind").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sized.groupBy("kind", "bucket").agg(F.sum("size").alias("b")).select("kind", "bucket", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("kind", "bucket").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    poured = materialise(
        sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["kind", "bucket"])
        .select("item", "size", "kind", (F.col("before") + F.col("inside")).alias("at"))
    )
    amounts = {r["kind"]: r["b"] for r in poured.groupBy("kind").agg(F.sum("size").alias("b")).collect()}  # 63 classes at most
    rule = None
    for kind in sorted(amounts, reverse=True):
        upto, edges = 0.0, []
        for part in level(loads, amounts[kind]):
            upto += part
            edges.append(upto)
        shard = _interval(edges, F.col("at"))
        rule = F.when(F.col("kind") == kind, shard) if rule is None else rule.when(F.col("kind") == kind, shard)
        got = _loads(poured.where(F.col("kind") == kind).select("size", shard.alias("shard")), shards)
        loads = [a + b for a, b in zip(loads, got)]
    return poured.select("item", (F.lit(0) if rule is None else rule).alias("shard"))


def assign_shards(items: DataFrame, links: DataFrame, shards: int = 40, rounds: int = 12) -> DataFrame:
    """`(item, shard)` for every item: few links cut, shards even in size.

    `items` holds `item` (a number, unique) and `size` (not negative); `links` holds `item` and `hub` (of any type): items of one hub are neighbours, an
    item may have many hubs, and a link between two items is a hub of two. Null hubs link nothing. A hub stands for all pairs of its items
    without listing them. Linked items take part in rounds of label propagation: hubs vote, items follow, quotas keep every shard within the mean size. Then free items,
    and what overfull shards give up, fill the gaps, so that shard sizes differ by about the size of a small item. Written out, so the result stays the same.
    """
    total = items.agg(F.sum("size")).first()[0] or 0
    capacity = max(total / shards, 1.0)
    known = _linked(items, links, capacity)
    if known is None:
        return materialise(_filled(items, [0] * shards, shards))
    labels = _propagated(*known, shards, capacity, rounds)
    free = items.select("item", "size").join(labels, "item", "left_anti")
    labels, given = _relieved(labels, shards, capacity)
    if given is None:
        filled = _filled(materialise(free), _loads(labels, shards), shards)
    else:
        parted = materialise(free.withColumn("unit", F.col("item").cast("string")).unionByName(given))
        units = parted.groupBy(F.col("unit").alias("item")).agg(F.sum("size").alias("size"))
        poured = _filled(materialise(units), _loads(labels, shards), shards)
        filled = parted.join(poured.withColumnRenamed("item", "unit"), "unit").select("item", "shard")
    return materialise(labels.select("item", "shard").unionByName(filled))


def with_slots(placed: DataFrame, shards: int) -> DataFrame:
    """Adds `slot`: 0, 1, 2 ... within each shard, in parts of bounded size."""
    buckets = max(1, math.ceil(placed.count() / shards / BUCKET_ROWS))
    dealt = placed.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("item"))
    return dealt.withColumn("inside", inside).join(starts, ["shard", "bucket"]).withColumn("slot", (F.col("before") + F.col("inside") - 1).cast("bigint")).drop("bucket", "inside", "before")


def shard_texts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), shards: int = 40, rounds: int = 12) -> DataFrame:
    """Kept columns with `size`, `text_crc32`, `shard` and `slot`: equal texts stay together as far as even sizes allow."""
    items = text_items(docs, text, keep)
    placed = with_slots(assign_shards(items.select("item", "size"), items.select("item", "hub"), shards, rounds), shards)
    return items.join(placed, "item").drop("item", "hub")


def write_shards(placed: DataFrame, path: str, files: int = 1) -> None:
    """One folder a shard with `files` files each, rows by slot."""
    shards = placed.agg(F.max("shard")).first()[0]
    parts = (0 if shards is None else shards + 1) * files
    placed.repartition(max(parts, 1), "shard", F.pmod("slot", F.lit(files))).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
