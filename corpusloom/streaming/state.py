"""Keyed state of streams in the state store: the active set and the last rows of each key, and reading it.

State lives in the store of the query's checkpoint, a value or a list a key: a batch touches the keys that it has rows of, no
state is written anew as a whole, and a query that is started again on the checkpoint goes on. What a store holds is read as a
table. A key that is done keeps its last row until the watermark has passed it, so that an older row that comes late can't bring it
back; then a timer takes it out of the state.
"""

from __future__ import annotations

import datetime
import heapq
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpusloom.streaming.events import drain

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """Queries that are started here have the state store that lists and timers need; others keep theirs."""
    old = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, old)


def _latest(rows: Iterator[pd.DataFrame], order: list[str], n: int) -> list[tuple]:
    """The last ``n`` rows, first to last; never more than these and a batch are held."""
    held = None
    for batch in rows:
        both = batch if held is None else pd.concat([held, batch])
        held = both.sort_values(order, kind="stable").tail(n)
    return [] if held is None else list(held.itertuples(index=False, name=None))


def _place(row: tuple, at: list[int]) -> tuple:
    return tuple(row[i] for i in at)


class ActiveKeys(StatefulProcessor):
    """The last row of each key, until the key is done and the watermark has passed it."""

    def __init__(self, schema: T.StructType, order: list[str], done: str, time: str):
        self.schema, self.order, self.done, self.time = schema, order, done, time
        self.at = [schema.names.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        (new,) = _latest(rows, self.order, 1)
        old = self.last.get() if self.last.exists() else None
        if old is None or _place(tuple(new), self.at) >= _place(tuple(old), self.at):
            self.last.update(tuple(x.to_pydatetime() if isinstance(x, pd.Timestamp) else x for x in new))
            if new[self.schema.names.index(self.done)]:
                moment = pd.Timestamp(new[self.schema.names.index(self.time)])
                self.handle.registerTimer(int(moment.timestamp() * 1000) + 1)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            row = self.last.get()
            moment = pd.Timestamp(row[self.schema.names.index(self.time)])
            if row[self.schema.names.index(self.done)] and int(moment.timestamp() * 1000) < expiredTimerInfo.getExpiryTimeInMs():
                self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


class LastRows(StatefulProcessor):
    """The last ``k`` rows of each key, as a list in order; nulls count as last, and of equal ones those that come later.

    It takes rows as they are: a key has few in a batch, and a frame for each of very many keys would cost far more than its rows.
    """

    def __init__(self, schema: T.StructType, order: list[str], k: int):
        self.schema, self.k = schema, k
        self.at = [schema.names.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.schema)

    def _by(self, numbered: tuple[int, tuple]) -> tuple:
        number, row = numbered
        # times come with their zone in rows and in the local one, unnamed, from the store
        place = (x.astimezone(datetime.UTC) if isinstance(x, datetime.datetime) else x for x in _place(row, self.at))
        return (*((True, None) if x is None or x != x else (False, x) for x in place), number)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        old = [tuple(r) for r in self.rows.get()] if self.rows.exists() else []
        kept = heapq.nlargest(self.k, enumerate(chain(old, map(tuple, rows))), key=self._by)
        self.rows.put([r for _, r in reversed(kept)])
        return iter(())

    def close(self) -> None:
        pass


def _run(stream: DataFrame, key: str, processor: StatefulProcessor, folder: str, time_mode: str, frames: bool = True) -> None:
    with rocks(stream.sparkSession):
        keyed = stream.groupBy(key)
        run = keyed.transformWithStateInPandas if frames else keyed.transformWithState
        out = run(processor, f"{key} string", "Update", time_mode)
        drain(out, folder, "update", each=lambda batch, _: batch.count())


def held(spark: SparkSession, folder: str, name: str, lists: bool = False) -> DataFrame:
    """The state ``name`` of the query whose checkpoint lies in ``folder``: its values, one row each."""
    reader = spark.read.format("statestore").option("stateVarName", name)
    with rocks(spark):
        rows = (reader.option("flattenCollectionTypes", "true") if lists else reader).load(f"{folder}/checkpoint")
        return rows.select("list_element.*" if lists else "value.*")


def active_keys(stream: DataFrame, key: str, order: list[str], done: str, time: str, late: str, folder: str) -> DataFrame:
    """The last row of each key that isn't ``done`` (a boolean column), of all that the stream has brought; the state is in ``folder``."""
    bounded = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    _run(bounded, key, ActiveKeys(bounded.schema, order, done, time), folder, "EventTime")
    return held(stream.sparkSession, folder, "last").filter(~F.col(done))


def last_rows(stream: DataFrame, key: str, order: list[str], k: int, folder: str) -> DataFrame:
    """The last ``k`` rows of each key of all that the stream has brought; the state is in ``folder``."""
    _run(stream, key, LastRows(stream.schema, order, k), folder, "None", frames=False)
    return held(stream.sparkSession, folder, "rows", lists=True)
