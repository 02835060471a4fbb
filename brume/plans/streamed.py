"""Streaming queries, run over all input that is there and read back."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from ..sources.scratch import shared_path
from ..streaming import streams as T
from . import views as V
from .messages import KINDEX, lines, sql
from .registry import query


def drained(stream, spark, name, mode="append"):
    """Write a stream's output until its input is used up, and read it."""
    path = shared_path(spark, name)
    schema = stream.schema
    run = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).format("parquet").start(path)
    run.awaitTermination()
    return spark.read.schema(schema).parquet(path)


@query(sql("SELECT idx, attrs, varname, count(*) AS n FROM (SELECT msg.idx, attrs, mapping.varname FROM msg JOIN mapping USING (attrs)) GROUP BY ALL", "msg", "mapping"))
def stream_idx(spark, d):
    path = shared_path(spark, "idx")
    lines(spark, d).select("value").write.text(path)
    out = drained(T.stream_idx(spark, path, V.mapping(spark, d)), spark, "stream-idx")
    return out.groupBy("idx", "attrs", "varname").agg(F.count("*").alias("n"))


def landed(df, spark, name):
    """A table as a stream of files."""
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


@query(sql("SELECT DISTINCT file, attrs FROM msg", "msg"))
def stream_dedupe(spark, d):
    m = V.msg_index(spark, d).select("file", "attrs", F.col("run_time").cast("timestamp").alias("run_time"))
    out = drained(T.stream_dedupe(landed(m, spark, "messages"), delay="3650 days"), spark, "stream-dedupe")
    return out.select("file", "attrs")


@query(sql("SELECT varname, cell, step_h, count(*) AS n FROM cells GROUP BY ALL", "cells"))
def stream_append_times(spark, d):
    c = V.cells(spark, d).select("varname", "cell", "member", "step_h", (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("step_h"))).alias("valid_time"))
    path = shared_path(spark, "times")
    for again in range(2):  # the second run finds every time there
        T.stream_append_times(landed(c, spark, f"cells{again}"), path, f"{path}-checkpoint{again}").awaitTermination()
    return spark.read.parquet(path).groupBy("varname", "cell", "step_h").agg(F.count("*").alias("n"))


@query(sql("SELECT varname, cell, TIMESTAMP '2024-01-02' + to_days(CAST(step_h // 24 AS INT)) AS window_end, CAST(sum(value) AS DOUBLE) AS total FROM cells WHERE step_h // 24 < (SELECT max(step_h) // 24 FROM cells) GROUP BY ALL", "cells"))
def stream_accumulate_24h(spark, d):
    c = V.cells(spark, d)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    timed = c.select("varname", "cell", F.col("value").cast("double").alias("value"), (start + F.make_dt_interval(hours=F.col("step_h"))).cast("timestamp").alias("valid_time"))
    out = drained(T.stream_accumulate_24h(landed(timed, spark, "cells")), spark, "stream-24h")
    last = c.agg(F.max(F.floor(F.col("step_h") / 24)).cast("int").alias("last")).select((start + F.make_dt_interval(F.col("last"))).alias("last"))
    ended = out.withColumn("window_end", F.col("window_end").cast("timestamp_ntz")).crossJoin(F.broadcast(last)).where("window_end <= last")
    return ended.select("varname", "cell", "window_end", F.round("total", 6).alias("total"))


@query(sql("SELECT varname, cell, w AS window_end, CAST(sum(value) AS DOUBLE) AS total FROM (SELECT varname, cell, value, TIMESTAMP '2024-01-01' + to_hours(CAST((step_h // 6 + k) * 6 AS INT)) AS w FROM cells, (SELECT unnest([1, 2, 3, 4]) AS k)) GROUP BY ALL", "cells"))
def stream_accumulate_sliding(spark, d):
    """24-hour totals each 6 hours, open windows too."""
    at = (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("step_h"))).cast("timestamp")
    timed = V.cells(spark, d).select("varname", "cell", F.col("value").cast("double").alias("value"), at.alias("valid_time"))
    path = shared_path(spark, "sliding")
    T.stream_totals(landed(timed, spark, "sliding-cells"), path, f"{path}-checkpoint", slide="6 hours").awaitTermination()
    totals = T.latest_totals(spark.read.parquet(path))
    return totals.select("varname", "cell", F.col("window_end").cast("timestamp_ntz").alias("window_end"), F.round("total", 6).alias("total"))


@contextlib.contextmanager
def rocks(spark):
    """The state store that streams with timers and maps need, for the time of a stream."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@query(sql("""SELECT run_date, CAST(n AS INT) AS n_members, n >= 36 AS complete FROM (SELECT run_date, min(first) AS first, count(DISTINCT number) AS n FROM (SELECT *, min(run_time) OVER (PARTITION BY run_date) AS first FROM (SELECT strftime(run_time, '%Y%m') AS run_date, number, run_time FROM msg))
WHERE run_time <= first + INTERVAL 240 HOURS GROUP BY 1) WHERE n >= 36 OR first + INTERVAL 240 HOURS <= (SELECT max(run_time) FROM msg) - INTERVAL 1 HOUR""", "msg"))
def stream_run_timeout(spark, d):
    """Runs (months) whose 36 members came within ten days of the first, and those that ran out of time."""
    m = V.msg_index(spark, d).select(F.date_format("run_time", "yyyyMM").alias("run_date"), "number", F.col("run_time").cast("timestamp").alias("arrived"))
    with rocks(spark):
        return drained(T.stream_run_timeout(landed(m, spark, "arrivals"), least=36, timeout_hours=240), spark, "stream-timeout")


@query(sql("SELECT strftime(run_time, '%Y%m') AS run_date FROM msg GROUP BY 1 HAVING count(DISTINCT number) >= 50", "msg"))
def stream_run_complete(spark, d):
    m = V.msg_index(spark, d).select(F.date_format("run_time", "yyyyMM").alias("run_date"), "number")
    with rocks(spark):
        return drained(T.stream_run_complete(landed(m, spark, "members")), spark, "stream-complete").select("run_date")
