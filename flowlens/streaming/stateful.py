"""User state with timers (K3, J3) on ``transformWithState``, and the state as a table.

``idle_counts`` keeps a count for each minute in a named value state on RocksDB
and sets an event-time timer behind the minute's newest record; when the
watermark passes the timer, the count is emitted and the state dropped.
``minute_state`` reads the counts and the timers' expiry times back from a
checkpoint with Spark's state reader: what a running query holds can be
inspected, joined and checked like any table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from flowlens.functions.timex import ntz_from_micros
from flowlens.streaming.packets import (
    IDLE_TIMEOUT_MS, MICROS_PER_MINUTE, RETENTION, _precount_et, record_micros, run_to_files,
)

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTS = "counts"       # name of the value state in the store


class MinuteCounter(StatefulProcessor):
    """Counts a minute's records; one timer ``timeout_ms`` behind its newest."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getValueState(COUNTS, "n BIGINT, last BIGINT")

    def _due(self, last: int) -> int:
        return last // 1000 + self.timeout_ms

    def handleInputRows(self, key, rows, timerValues):
        before = self.counts.get()
        n, last = (int(before[0]), int(before[1])) if before else (0, 0)
        newest = last
        for pdf in rows:
            n += int(pdf["n"].sum())
            newest = max(newest, int(pdf["us"].max()))
        self.counts.update((n, newest))
        if not before or newest > last:
            if before:
                self.handle.deleteTimer(self._due(last))
            self.handle.registerTimer(self._due(newest))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        n = int(self.counts.get()[0])
        self.counts.clear()
        yield pd.DataFrame({"minute": [int(key[0])], "count": [n]})

    def close(self) -> None:
        pass


def idle_counts(stream: DataFrame, timeout_ms: int = IDLE_TIMEOUT_MS, retention: str = RETENTION) -> DataFrame:
    """J3 with a user state processor: the rows of ``idle_flush_counts_event_time``.

    Records are counted per Arrow batch before the state shuffle, and a minute is
    late as a whole or not at all, as there."""
    from flowlens.session import ship_package
    ship_package(stream.sparkSession)
    us = record_micros(F.col("key"))
    keyed = stream.select(F.floor(us / MICROS_PER_MINUTE).cast("bigint").alias("m"), us.alias("us"))
    pre = keyed.mapInPandas(_precount_et, "m BIGINT, n BIGINT, us BIGINT")
    pre = pre.withColumn("et", F.timestamp_micros(F.col("m") * MICROS_PER_MINUTE)) \
             .withWatermark("et", f"{retention} 1 minute")
    out = pre.groupBy("m").transformWithStateInPandas(
        MinuteCounter(timeout_ms), "minute BIGINT, count BIGINT", "append", "eventTime")
    return out.select(ntz_from_micros(F.col("minute") * MICROS_PER_MINUTE).alias("minute"), "count")


def run_with_state(df: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """``run_to_files`` on RocksDB state. The query takes the provider when it
    starts; the session's own setting is restored right after."""
    spark = df.sparkSession
    old = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return run_to_files(df, path, checkpoint, **options)
    finally:
        spark.conf.set(PROVIDER, old)


def minute_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(minute, count, expires_ms) that the last batch of a checkpoint holds."""
    def read(option, value):
        return spark.read.format("statestore").option(option, value).load(checkpoint)
    counts = read("stateVarName", COUNTS).select(F.col("key.m").alias("m"), F.col("value.n").alias("count"))
    timers = read("readRegisteredTimers", "true").select(F.col("key.m").alias("m"),
                                                         F.col("expiration_timestamp_ms").alias("expires_ms"))
    return counts.join(timers, "m", "full").select(
        ntz_from_micros(F.col("m") * MICROS_PER_MINUTE).alias("minute"), "count", "expires_ms")
