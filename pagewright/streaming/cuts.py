"""Streaks over a growing page log, with keyed state.

The log's files come one after the other; per key the state is how many rows in a row were empty, whether the
cut has been reached, and the last row seen. So a run over what has come since the last one goes on where that
one stopped, also after a restart, and all runs together give what the cuts of
:mod:`pagewright.operators.log` give for the whole log.

Within a run of files rows may come in any order; a row that comes in a later run than one that follows it is
marked ``late`` and changes nothing. A row that comes ``idle`` or more after all rows of its key before begins
anew, and the state of a key goes when the time of the stream has moved that far. Rows without time never arrive at the state and are dropped by the
stream, as are rows older than its watermark.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "streak long, stopped boolean, last long, expires long"


class Streaks(StatefulProcessor):
    """Per key: rows in order, each with its streak and whether it comes before the cut."""

    def __init__(self, order: str, empty: str, time: str, limit: int | None, idle_ms: int, columns: list[str]) -> None:
        self.order, self.empty, self.time, self.limit, self.idle_ms, self.columns = order, empty, time, limit, idle_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("streak", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        streak, stopped, last, expires = self.state.get() if self.state.exists() else (0, False, None, None)
        # the rows of a key in one run of files
        batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        streaks, kept, late = [], [], []
        moments = batch[self.time].map(lambda t: int(t.timestamp() * 1000) + self.idle_ms)
        timer = expires
        for at, is_empty, moment in zip(batch[self.order], batch[self.empty], moments, strict=True):
            late.append(last is not None and int(at) <= last)
            if late[-1]:
                streaks.append(None)
                kept.append(False)
                continue
            if expires is not None and moment - self.idle_ms >= expires:
                streak, stopped = 0, False
            streak = streak + 1 if is_empty else 0
            streaks.append(streak)
            kept.append(not stopped)
            stopped = stopped or (self.limit is not None and streak >= self.limit)
            last, expires = int(at), moment if expires is None else max(expires, moment)
        if timer != expires:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(expires)
        self.state.update((streak, stopped, last, expires))
        out = batch[self.columns].copy()
        out["streak"] = pd.array(streaks, dtype="Int64")
        yield out.assign(kept=kept, late=late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def with_streaks(
    log: DataFrame, keys, order: str, empty: str, time: str, limit: int | None = None, delay: str = "0 seconds", idle_days: float = 36500,
) -> DataFrame:
    """The streaming table ``log`` with ``streak`` (rows in a row, this one included, where ``empty`` is
    true), ``kept`` (whether it comes before or with the row that makes ``limit`` in a row) and ``late``."""
    log.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = T.StructType([*log.schema.fields, T.StructField("streak", T.LongType()), T.StructField("kept", T.BooleanType()), T.StructField("late", T.BooleanType())])
    watched = log.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    out[time].dataType = T.TimestampType()
    processor = Streaks(order, empty, time, limit, int(idle_days * 86_400_000), log.columns)
    return watched.groupBy(*keys).transformWithStateInPandas(processor, out, outputMode="append", timeMode="eventTime")


def read_folder(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """The growing folder ``path`` of Parquet files as a stream; files are taken by their age."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(path)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
