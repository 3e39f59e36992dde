"""Keyed state of streams: the last rows of each model, and what scoring needs to know of each card.

State lives in Spark's state store, one entry a key, saved with the query's checkpoint: a restart goes on where the last batch ended, and a
batch that is repeated finds the state it had before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..config import DEFAULT, FeatureConfig
from ..operators.validate import align_columns, canonical_headers, clean_null_tokens, typed_rows
from ..plans.features import with_card_id
from .drift import WINDOW_ROWS, recent_rows

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR = 3600
PARTS = 16        # parts of a model's window, so that one busy model is not one task
FORGET = 90 * 24 * HOUR
PRODUCT = "ProductCD"


@contextmanager
def keyed_store(spark: SparkSession):
    """The state store that lists and timers need, for queries started inside."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


# ---- last rows of a model ----------------------------------------------------------------------


class LastRows(StatefulProcessor):
    """Keeps the `n` latest rows of a key in a list and tells how many it holds."""

    def __init__(self, kept: T.StructType, order: tuple[str, ...], n: int):
        self.kept, self.places, self.n = kept, [kept.names.index(c) for c in order], n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.kept)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self.rows.get()] if self.rows.exists() else []
        held += [tuple(r[c] for c in self.kept.names) for r in rows]
        held.sort(key=lambda r: tuple((r[p] is not None, r[p]) for p in self.places), reverse=True)
        self.rows.put(held[: self.n])
        yield Row(model=key[0], part=key[1], rows=min(len(held), self.n))

    def close(self) -> None:
        pass


def keep_recent(
    stream: DataFrame, checkpoint: str, n: int = WINDOW_ROWS, key: str = "model_version", order=("sec", "seq"), parts: int = PARTS, available_now: bool = False,
) -> StreamingQuery:
    """Keep the `n` latest rows of every key while the stream runs; `kept_rows` reads them at any time.

    A key's rows are dealt to `parts` lists by a hash of the order columns, each with its own `n` latest, so state is bounded by
    keys * parts * n rows and no key is bound to one task. A missing key is a key.
    """
    kept = T.StructType([f for f in stream.schema.fields if f.name != key])
    part = F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int")
    counted = stream.select("*", part.alias("__part")).groupBy(key, "__part").transformWithState(
        LastRows(kept, tuple(order), n), f"model {stream.schema[key].dataType.simpleString()}, part int, rows bigint", "Update", "None"
    )
    with keyed_store(stream.sparkSession):
        writer = counted.writeStream.outputMode("update").option("checkpointLocation", checkpoint).format("noop")
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def kept_rows(spark: SparkSession, checkpoint: str, n: int = WINDOW_ROWS, key: str = "model_version", order=("sec", "seq")) -> DataFrame:
    """The `n` latest rows of every key as of the last finished batch, read from the state store."""
    state = spark.read.format("statestore").option("stateVarName", "rows").option("flattenCollectionTypes", "true").load(checkpoint)
    return recent_rows(state.select(F.col(f"key.{key}").alias(key), "list_element.*"), n, key, order)


# ---- what scoring knows of a card --------------------------------------------------------------


class CardHistory(StatefulProcessor):
    """Hands over each batch's rows of a card together with the earlier rows that their features look back to.

    Features look back an hour (velocity), `rolling` rows (median, previous amount, gap) and to the last known product. Rows behind the watermark
    by more than an hour are dropped but for those; a timer does that for cards that stay quiet, and forgets them after `forget` seconds.
    """

    def __init__(self, names: list[str], past: T.StructType, cfg: FeatureConfig, forget: int):
        self.names, self.past, self.forget = names, past, forget
        self.time, self.id, self.product = cfg.time_col, cfg.id_col, PRODUCT
        self.rolling = cfg.rolling_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.past)

    def _kept(self, rows: list[dict], watermark: float) -> list[dict]:
        old = [r for r in rows if r[self.time] <= watermark - HOUR]
        known = [r for r in old if r.get(self.product) is not None][-1:]
        near = old[-self.rolling :]
        return [r for r in known if r not in near] + near + rows[len(old) :]

    def _store(self, rows: list[dict], watermark: float, cards_end: bool) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        newest = rows[-1][self.time]
        if cards_end and newest + self.forget <= watermark:
            self.rows.clear()
            return
        self.rows.put([tuple(r[c] for c in self.past.names) for r in rows])
        wake = newest + 2 * HOUR if newest + 2 * HOUR > watermark else newest + self.forget
        self.handle.registerTimer(int(max(wake, watermark + 1) * 1000))

    def _held(self) -> list[dict]:
        return [dict(zip(self.past.names, r)) for r in self.rows.get()] if self.rows.exists() else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        shape = Row(*self.names, "__past")
        watermark = timerValues.getCurrentWatermarkInMs() / 1000
        held = self._held()
        for r in held:
            yield shape(*[r.get(c) for c in self.names], True)
        for row in rows:
            values = row.asDict()
            yield shape(*[values[c] for c in self.names], False)
            if not values["row_errors"] and values[self.time] is not None:
                held.append({c: values[c] for c in self.past.names})
        if held:
            held.sort(key=lambda r: (r[self.time], r[self.id] is not None, r[self.id]))
            self._store(self._kept(held, watermark), watermark, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() / 1000
        held = self._held()
        if held:
            self._store(self._kept(held, watermark), watermark, True)
        return iter([])

    def close(self) -> None:
        pass


def with_card_history(
    stream: DataFrame, expected: T.StructType, cfg: FeatureConfig = DEFAULT, delay: str = "1 hour", forget: int = FORGET,
) -> DataFrame:
    """Arriving rows, typed and aligned, with `row_errors`, and the earlier rows of their cards marked `__past`.

    Rows later than `delay` behind the newest event time, as of the batch before the last, are not handed over; the query's progress counts them
    (`numRowsDroppedByWatermark`). A row without a time is handed over, but later rows do not see it.
    """
    named = clean_null_tokens(canonical_headers(stream, expected.names))
    checked = typed_rows(named, expected)
    typed = align_columns(checked, T.StructType([*expected.fields, checked.schema["row_errors"]]), cfg.target_col)
    carded = with_card_id(typed, cfg).withColumn("__at", F.timestamp_seconds(F.col(cfg.time_col)))
    looked_at = (cfg.id_col, cfg.time_col, cfg.amount_col, PRODUCT, *cfg.card_cols)
    past = T.StructType([f for f in typed.schema.fields if f.name in looked_at])
    shape = T.StructType([*[T.StructField(f.name, f.dataType) for f in typed.schema.fields], T.StructField("__past", T.BooleanType())])
    processor = CardHistory(typed.schema.names, past, cfg, forget)
    return carded.withWatermark("__at", delay).groupBy("card_id").transformWithState(processor, shape, "Append", "EventTime")


def score_cards(
    stream: DataFrame, expected: T.StructType, score: Callable[[DataFrame, DataFrame], DataFrame], out: str, checkpoint: str, cfg: FeatureConfig = DEFAULT,
    delay: str = "1 hour", available_now: bool = False, reports: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> StreamingQuery:
    """Score arriving rows with the history of their cards: `score(rows, history)`, as `FraudModel.predict_proba` takes them.

    Predictions, rejected rows and `reports` made from the predictions go to one folder per batch id, written whole, so a repeated batch replaces its output.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            new = held.where("NOT __past").drop("__past")
            bad = F.size("row_errors") > 0
            new.where(bad).write.mode("overwrite").parquet(f"{out}/rejected/batch={batch_id}")
            scored = score(new.where(~bad).drop("row_errors"), held.where("__past").drop("__past", "row_errors"))
            scored.write.mode("overwrite").parquet(f"{out}/predictions/batch={batch_id}")
        finally:
            held.unpersist()
        scored = batch.sparkSession.read.parquet(f"{out}/predictions/batch={batch_id}")
        for name, report in (reports or {}).items():
            report(scored).write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")

    with keyed_store(stream.sparkSession):
        writer = with_card_history(stream, expected, cfg, delay).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(step)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
