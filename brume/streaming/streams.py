"""Streams of index files and cells; each equals its batch operator once all input has come."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..sources.index_files import read_idx
from ..sources.stores import new_times


def stream_idx(spark: SparkSession, path: str, mapping: DataFrame) -> DataFrame:
    """Mapped messages of index files as they land in a folder."""
    lines = spark.readStream.text(path).select("value", F.col("_metadata.file_path").alias("idx_uri"))
    return read_idx(lines).join(mapping, "attrs")


def stream_dedupe(messages: DataFrame, time: str = "run_time", delay: str = "1 day", keys: tuple[str, ...] = ("file", "attrs")) -> DataFrame:
    """Each message once, within the watermark."""
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_append_times(cells: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append rows at unseen valid times to a table, batch by batch."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            old = spark.read.parquet(path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            batch.write.parquet(path)
            return
        new_times(batch, old).write.mode("append").parquet(path)

    return cells.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_accumulate_24h(cells: DataFrame, width: str = "24 hours", slide: str | None = None, delay: str = "3 hours") -> DataFrame:
    """Sums by variable and cell in windows of valid time; rows behind the watermark are dropped."""
    span = F.window("valid_time", width, slide) if slide else F.window("valid_time", width)
    return cells.withWatermark("valid_time", delay).groupBy("varname", "cell", span.alias("w")).agg(F.sum("value").alias("total")).select("varname", "cell", F.col("w.end").alias("window_end"), "total")


def stream_totals(cells: DataFrame, path: str, checkpoint: str, width: str = "24 hours", slide: str | None = None, delay: str = "3 hours") -> StreamingQuery:
    """`stream_accumulate_24h` kept as a table of updates: each batch adds its windows' totals so far, under its number.

    A window has a total from its first row on, not only when the watermark has passed it; a batch that is repeated after a
    failure writes its folder again. `latest_totals` reads the table, `late_rows` counts what the watermark has dropped.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    sums = stream_accumulate_24h(cells, width, slide, delay)
    return sums.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_totals(updates: DataFrame) -> DataFrame:
    """The last total of each window in a table of updates."""
    return updates.groupBy("varname", "cell", "window_end").agg(F.max_by("total", "batch").alias("total"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that this run of a query dropped as behind the watermark (of an aggregation: one for each task, key and window)."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


class _RunMembers(StatefulProcessor):
    def __init__(self, least: int):
        self.least = least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("members", "number INT", "n INT")
        self.done = handle.getValueState("done", "done BOOLEAN")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            for number in part["number"].unique():
                self.seen.updateValue((int(number),), (1,))
        members = len(list(self.seen.keys()))
        if members >= self.least and not self.done.exists():
            self.done.update((True,))
            yield pd.DataFrame({"run_date": [key[0]], "n_members": [members]})

    def close(self) -> None:
        pass


def stream_run_complete(messages: DataFrame, least: int = 50) -> DataFrame:
    """A row once a run date has `least` members. `messages`: run_date (string), number."""
    return messages.groupBy("run_date").transformWithStateInPandas(_RunMembers(least), "run_date STRING, n_members INT", "Append", "None")


class _RunUntil(StatefulProcessor):
    """Members of a run with their earliest arrival; a timer at the first arrival and `timeout_ms`."""

    def __init__(self, least: int, timeout_ms: int):
        self.least, self.timeout_ms = least, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("members", "number INT", "at LONG")
        self.first = handle.getValueState("first", "at LONG")
        self.done = handle.getValueState("done", "done BOOLEAN")

    def _count(self) -> int:
        last = self.first.get()[0] + self.timeout_ms
        return sum(at[0] <= last for at in self.seen.values())

    def _row(self, key, n: int, complete: bool) -> pd.DataFrame:
        return pd.DataFrame({"run_date": [key[0]], "n_members": [n], "complete": [complete]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest: dict[int, int] = {}
        for part in rows:
            for number, at in part.groupby("number")["at"].min().items():
                earliest[int(number)] = min(int(at), earliest.get(int(number), int(at)))
        if not earliest or self.done.exists():
            return
        for number, at in earliest.items():
            if not self.seen.containsKey((number,)) or self.seen.getValue((number,))[0] > at:
                self.seen.updateValue((number,), (at,))
        before, now = self.first.get() if self.first.exists() else None, min(earliest.values())
        if before is None or now < before[0]:
            if before is not None:
                self.handle.deleteTimer(before[0] + self.timeout_ms)
            self.first.update((now,))
            self.handle.registerTimer(now + self.timeout_ms)
        n = self._count()
        if n >= self.least:
            self.handle.deleteTimer(self.first.get()[0] + self.timeout_ms)
            self._end()
            yield self._row(key, n, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.done.exists():
            n = self._count()
            self._end()
            yield self._row(key, n, False)

    def _end(self) -> None:
        self.done.update((True,))
        self.seen.clear()

    def close(self) -> None:
        pass


def stream_run_timeout(messages: DataFrame, least: int = 50, timeout_hours: int = 24, delay: str = "1 hour") -> DataFrame:
    """A row for each run date: once `least` members have arrived within `timeout_hours` of its first (complete), else once the watermark
    has passed that time (not complete). `messages`: run_date (string), number, arrived (timestamp). A run comes out once, and keeps
    no members after that; members that arrive later than the timeout do not count; null members or times are ignored."""
    timed = messages.where("number IS NOT NULL AND arrived IS NOT NULL").withWatermark("arrived", delay)
    timed = timed.select("run_date", F.col("number").cast("int").alias("number"), F.unix_millis("arrived").alias("at"), "arrived")
    return timed.groupBy("run_date").transformWithStateInPandas(_RunUntil(least, timeout_hours * 3_600_000), "run_date STRING, n_members INT, complete BOOLEAN", "Append", "EventTime")
