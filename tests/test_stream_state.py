"""Keyed state: what is kept of a card is all that later rows look back to; quiet cards are forgotten; late rows are counted."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from ledgerlens.config import DEFAULT
from ledgerlens.session import scratch_path
from ledgerlens.streaming import state
from ledgerlens.streaming.scoring import arriving_rows

PAST = T.StructType([T.StructField("TransactionID", T.LongType()), T.StructField("TransactionDT", T.LongType()), T.StructField("TransactionAmt", T.DoubleType()), T.StructField("ProductCD", T.StringType())])


class Store:
    """Stands for the handle of one key: a list and its timers."""

    def __init__(self):
        self.rows, self.timers = [], set()

    def getListState(self, name, schema):
        return SimpleNamespace(get=lambda: iter(self.rows), put=lambda r: setattr(self, "rows", r), exists=lambda: bool(self.rows), clear=lambda: setattr(self, "rows", []))

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def at(seconds):
    return SimpleNamespace(getCurrentWatermarkInMs=lambda: int(seconds * 1000))


def card():
    store = Store()
    processor = state.CardHistory([*PAST.names, "row_errors"], PAST, DEFAULT, state.FORGET)
    processor.init(store)
    return store, processor


def looked_back(rows, now):
    """What the features of a row take from the rows before it."""
    earlier = [r for r in rows if (r[1], r[0]) < (now[1], now[0])]
    product = [r[3] for r in earlier if r[3] is not None][-1:]
    return [r[2] for r in earlier[-5:]], sum(now[1] - 3600 < r[1] for r in earlier), product, earlier[-1][1] if earlier else None


def test_kept_rows_are_enough():
    rnd = random.Random(3)
    store, processor = card()
    seen, clock, most = [], 0, 0
    for k in range(300):
        batch = []
        for _ in range(rnd.randrange(1, 5)):
            clock += rnd.choice((0, 1, 50, 900, 4000))
            batch.append((len(seen) + len(batch), clock - rnd.choice((0, 0, 0, 3000)), rnd.random(), rnd.choice((None, None, "W", "C"))))
        newest = max([r[1] for r in seen], default=0)
        batch = [r for r in batch if r[1] > newest - 3600] or [(len(seen), newest, 1.0, None)]
        out = list(processor.handleInputRows(("k",), [Row(**dict(zip(PAST.names, r)), row_errors=[]) for r in batch], at(max(newest - 3600, 0))))
        given = sorted([tuple(r)[:4] for r in out], key=lambda r: (r[1], r[0]))
        seen = sorted(seen + batch, key=lambda r: (r[1], r[0]))
        for r in batch:
            assert looked_back(given, r) == looked_back(seen, r)
        assert sum(r[-1] for r in out) == len(out) - len(batch) and len(store.timers) == 1
        most = max(most, len(store.rows))
    assert most < 60 < len(seen)


def test_quiet_cards_shrink_and_are_forgotten():
    store, processor = card()
    rows = [Row(TransactionID=k, TransactionDT=k, TransactionAmt=1.0, ProductCD="W" if k == 0 else None, row_errors=[]) for k in range(100)]
    list(processor.handleInputRows(("k",), rows, at(0)))
    assert len(store.rows) == 100
    timer = min(store.timers)
    list(processor.handleExpiredTimer(("k",), at(timer / 1000), None))
    assert [r[0] for r in store.rows] == [0, 95, 96, 97, 98, 99] and len(store.timers) == 1
    list(processor.handleExpiredTimer(("k",), at(min(store.timers) / 1000 + 1), None))
    assert store.rows == [] and not store.timers


def test_faulty_rows_pass_but_are_not_kept():
    store, processor = card()
    out = list(processor.handleInputRows(("k",), [Row(TransactionID=1, TransactionDT=None, TransactionAmt=1.0, ProductCD="W", row_errors=[]), Row(TransactionID=2, TransactionDT=5, TransactionAmt=None, ProductCD="W", row_errors=["x"])], at(0)))
    assert [r["__past"] for r in out] == [False, False] and store.rows == []


def test_last_rows_keep_order_and_bound():
    store = Store()
    keeper = state.LastRows(T.StructType([T.StructField("sec", T.LongType()), T.StructField("seq", T.LongType())]), ("sec", "seq"), 3)
    keeper.init(store)
    for batch in ([(5, 1), (None, 9), (7, 2)], [(6, 3)], [(1, 4), (7, 5)]):
        out = list(keeper.handleInputRows((None, 0), [Row(sec=a, seq=b) for a, b in batch], None))
    assert store.rows == [(7, 5), (7, 2), (6, 3)] and out == [Row(model=None, part=0, rows=3)]


def test_late_rows_are_counted(spark, txn):
    inbox, out, ck = (scratch_path(spark, f"late-{n}") for n in ("in", "out", "ck"))
    rows = txn.drop("isFraud", "score")
    late = rows.selectExpr("max(TransactionDT)").first()[0] - 6 * 3600
    fresh = rows.where(f"TransactionDT > {late + 6 * 3000}")
    # a batch is held to the watermark of the one before the last
    for part in (fresh, fresh.limit(1), rows.where(f"TransactionDT <= {late}").limit(7), fresh.limit(1)):
        part.coalesce(1).write.mode("append").parquet(inbox)
    stream = arriving_rows(spark, inbox, rows.schema, files_per_batch=1)
    score = lambda new, history: new.select("TransactionID")
    query = state.score_cards(stream, rows.schema, score, out, ck, available_now=True, reports={"counts": lambda p: p.groupBy().count()})
    query.awaitTermination()
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
    first = fresh.count()
    assert dropped == 7 and spark.read.parquet(f"{out}/predictions").count() == first + 2 and first > 0
    assert spark.read.parquet(f"{out}/counts").selectExpr("sum(count)").first()[0] == first + 2
