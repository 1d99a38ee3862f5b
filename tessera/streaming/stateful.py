"""Streams with state: runs that start, end or time out; first rows that win; sessions and sliding windows.

All of these also take tables that don't stream, with the same results as a stream that is read to its end, but for what a
watermark still holds back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import store
from . import ingest

#: Statuses that end a run.
FINAL = ("completed", "error", "partial", "skipped_too_large")
#: Times are microseconds since 1970 here, which no time zone changes.
ATTEMPTS = "run string, status string, started long, ended long, events long"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state with timers needs this store of states; it keeps state on disk, so its size is no matter of memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Attempts(StatefulProcessor):
    """The state machine of one run: none, in progress, and back to none with a row out when it ends or times out."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("attempt", "started long, last long, events long")

    def _due(self, last: int) -> int:
        return last // 1000 + self.timeout_ms

    def _put(self, state: tuple | None, timer: int | None) -> None:
        """Stores the attempt (None: there is none) with a timer for when it would be over, in place of the one before."""
        if timer is not None:
            self.handle.deleteTimer(timer)
        if state is None:
            self.now.clear()
        else:
            self.now.update(state)
            self.handle.registerTimer(self._due(state[1]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.now.get() if self.now.exists() else None
        state, timer = (tuple(held), self._due(held[1])) if held else (None, None)
        for row in sorted(rows, key=lambda r: (r.micros, r.tie)):
            if state and row.micros - state[1] > self.timeout_ms * 1000:
                yield Row(run=key[0], status="timed_out", started=state[0], ended=state[1], events=state[2])
                state = None
            state = (state[0], max(state[1], row.micros), state[2] + 1) if state else (row.micros, row.micros, 1)
            if row.status in FINAL:
                yield Row(run=key[0], status=row.status, started=state[0], ended=state[1], events=state[2])
                state = None
        self._put(state, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.now.exists():
            started, last, events = self.now.get()
            if self._due(last) <= expiredTimerInfo.getExpiryTimeInMs():
                self.now.clear()
                yield Row(run=key[0], status="timed_out", started=started, ended=last, events=events)

    def close(self) -> None:
        pass


def attempts(stream: DataFrame, run: str, status: str, ts: str, tie: Column | str, timeout: dt.timedelta, late: str) -> DataFrame:
    """A stream of run, status and time to one row an attempt that is over: run, status, started, ended, events.

    A run's first row starts an attempt, a FINAL status ends it, and it has timed out if nothing comes for `timeout` of event
    time, which a timer tells when the watermark has gone by; the next row starts another attempt. Rows of one time are
    taken by `tie`. Rows later than `late` are left out, as are those without a run or time. A run's state is three
    numbers, however many rows it has; what reaches it in one micro-batch is sorted in memory, which maxFilesPerTrigger bounds."""
    kind = stream.schema[ts].dataType
    rows = stream.select(F.col(run).cast("string").alias("run"), F.col(status).alias("status"), F.col(ts).cast("timestamp").alias("ts"), (F.col(tie) if isinstance(tie, str) else tie).cast("long").alias("tie"))
    rows = rows.where("run IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", late).withColumn("micros", F.unix_micros("ts"))
    over = rows.groupBy("run").transformWithState(Attempts(int(timeout.total_seconds() * 1000)), ATTEMPTS, "Append", "EventTime")
    return over.select("run", "status", *[F.timestamp_micros(c).cast(kind).alias(c) for c in ("started", "ended")], "events")


def first_wins(stream: DataFrame, key: str, ts: str, late: str) -> DataFrame:
    """The first row of each key; a repetition is known as long as the watermark has not passed the first row's time by `late`,
    after which its state goes."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def first_into_table(stream: DataFrame, table: str, key: str, ts: str, late: str, checkpoint: str) -> StreamingQuery:
    """Rows of unknown keys into a stored table, the first of each by time; later rows of known keys change nothing, however late
    they are: what the watermark no longer knows, the table does."""
    unique = first_wins(stream, key, ts, late)
    return ingest.into_table(unique, table, lambda old, batch: store.insert_missing(batch.limit(0) if old is None else old, batch.withColumn("_ts", F.col(ts)), key, "_ts"), checkpoint)


def sessions(df: DataFrame, ts: str, keys: list[str], value: str, gap: str, late: str | None = None) -> DataFrame:
    """keys, start, end, n, total of runs of rows with less than `gap` between neighbours. Rows without a time are left out."""
    df = df.withWatermark(ts, late) if late else df
    by = df.groupBy(*keys, F.session_window(ts, gap).alias("_s")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return by.select(*keys, F.col("_s.start").alias("start"), F.col("_s.end").alias("end"), "n", "total")


def sliding(df: DataFrame, ts: str, keys: list[str], value: str, width: str, step: str, late: str | None = None) -> DataFrame:
    """keys, start, n, total of windows of a width that begin at each step; a row is in width / step of them."""
    df = df.withWatermark(ts, late) if late else df
    by = df.groupBy(*keys, F.window(ts, width, step).alias("_w")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return by.select(*keys, F.col("_w.start").alias("start"), "n", "total")


def to_the_end(stream: DataFrame, folder: str) -> DataFrame:
    """Runs a stream over all that is there now, into a folder, and reads that: each row once, also after a restart."""
    stream.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")
