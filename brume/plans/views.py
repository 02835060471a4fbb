"""Forecast-shaped views of the driver's tables, in Spark and (CTES) in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROWS_A_TASK = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks_for(*tables: DataFrame) -> int:
    """Partitions that hold about ROWS_A_TASK rows each; rows of files are counted from their footers."""
    return max(tables[0].sparkSession.sparkContext.defaultParallelism, -(-sum(t.count() for t in tables) // ROWS_A_TASK))


def msg_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per message: an order is a file, its lineitems are the messages.

    Both tables are dealt by file over as many partitions as their rows ask for: the sorts of the join and of the windows
    hold all rows of a task, and shuffles of a fixed number of partitions would grow with the tables.
    """
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    n = tasks_for(lines, orders)
    lines, orders = lines.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey")
    by = Window.partitionBy("file")
    order = by.orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).withColumnRenamed("l_orderkey", "file").withColumn("length", F.col("l_quantity").cast("bigint") * 1000)
    step = (F.pmod("file", F.lit(81)) * 3).cast("int")
    rows = joined.select(
        "file", F.concat(F.lit("s3://archive/f"), F.col("file").cast("string")).alias("uri"), F.row_number().over(order).alias("idx"),
        (F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).alias("offset"), "length", F.sum("length").over(by).alias("file_size"),
        F.lower(F.concat("l_returnflag", "l_linestatus")).alias("code"), F.col("l_linenumber").cast("int").alias("level_no"), step.alias("step_h"),
        F.pmod("file", F.lit(51)).cast("int").alias("number"), F.col("o_orderdate").cast("timestamp_ntz").alias("run_time"),
    )
    return rows.withColumn("attrs", F.concat("code", F.lit(":"), (F.col("level_no") * 100).cast("string"), F.lit(" mb:"), F.col("step_h").cast("string"), F.lit(" hour fcst:")))


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template: attrs to variable, level and step. Level 7 is left out, so some messages stay unmapped."""
    rows = msg_index(spark, sf_dir).where("level_no < 7")
    step_type = F.when(F.substring("code", 2, 1) == "o", "instant").otherwise("accum")
    return rows.select("attrs", F.col("code").alias("varname"), F.lit("isobaricInhPa").alias("typeOfLevel"), step_type.alias("stepType"), (F.col("level_no") * 100.0).cast("double").alias("level"), F.col("step_h").alias("map_step_h")).distinct()


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast cells: events by type (variable), member, step and cell."""
    e = table(spark, sf_dir, "events")
    step = (F.floor(F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)") / 10800) * 3).cast("int")
    k = F.pmod(F.get_json_object("props", "$.k").cast("int"), F.lit(10))
    keyed = e.select(F.col("event_type").alias("varname"), F.pmod("user_id", F.lit(5)).cast("int").alias("member"), step.alias("step_h"), k.alias("cell"), F.col("value").cast("decimal(18,2)").alias("v"))
    out = keyed.groupBy("varname", "member", "step_h", "cell").agg(F.sum("v").cast("decimal(18,2)").alias("value"))
    return out.withColumns({"lat": F.lit(-12.0) + F.lit(3.5) * F.col("cell"), "lon": F.lit(21.0) + F.lit(3.2) * F.col("cell")})


def cells_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All variables x members x cells x steps, 0 where nothing was reported."""
    c = cells(spark, sf_dir)
    top = c.agg(F.max("step_h").alias("top"))
    axes = c.select("varname").distinct().crossJoin(F.broadcast(top))
    for name, values in (("step_h", F.sequence(F.lit(0), F.col("top"), F.lit(3))), ("member", F.sequence(F.lit(0), F.lit(4))), ("cell", F.sequence(F.lit(0), F.lit(9)))):
        axes = axes.withColumn(name, F.explode(values))
    full = axes.drop("top").join(c.drop("lat", "lon"), ["varname", "member", "step_h", "cell"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("decimal(18,2)")))
    return full.withColumns({"lat": F.lit(-12.0) + F.lit(3.5) * F.col("cell"), "lon": F.lit(21.0) + F.lit(3.2) * F.col("cell")})


def cells_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = F.pmod(F.col("member") + (F.col("step_h") / 3).cast("int") + F.col("cell"), F.lit(11)) == 0
    return cells_dense(spark, sf_dir).withColumn("value", F.when(missing, F.lit(float("nan"))).otherwise(F.col("value").cast("double")))


def cells_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precipitation since the start of the run, in thousandths."""
    w = Window.partitionBy("varname", "member", "cell").orderBy("step_h").rowsBetween(Window.unboundedPreceding, 0)
    return cells_dense(spark, sf_dir).withColumn("value", (F.sum("value").over(w)).cast("decimal(18,2)"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an archive: one per order; the index file is there if the order has lineitems."""
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    joined = o.join(l, o["o_orderkey"] == l["l_orderkey"], "left")
    path = F.format_string("s3://bucket/gefs.%s/%02d/atmos/gep%02d.t00z.f%03d", F.date_format("o_orderdate", "yyyyMMdd"), F.pmod("o_orderkey", F.lit(4)) * 6, F.pmod("o_orderkey", F.lit(30)) + 1, F.pmod("o_orderkey", F.lit(81)) * 3)
    return joined.select(F.col("o_orderkey").alias("file"), path.alias("path"), (F.col("o_totalprice") * 1000).cast("bigint").alias("size"), F.col("l_orderkey").isNotNull().alias("has_idx"), F.col("o_orderdate").cast("timestamp_ntz").alias("run_time"))


CTES = {
    "msg": """msg AS (SELECT file, 's3://archive/f' || file AS uri, CAST(row_number() OVER o AS INT) AS idx, CAST(sum(length) OVER (o ROWS UNBOUNDED PRECEDING) - length AS BIGINT) AS "offset", length,
  CAST(sum(length) OVER (PARTITION BY file) AS BIGINT) AS file_size, code, level_no, step_h, number, run_time, code || ':' || (level_no * 100) || ' mb:' || step_h || ' hour fcst:' AS attrs FROM (
  SELECT l_orderkey AS file, CAST(l_quantity AS BIGINT) * 1000 AS length, lower(l_returnflag || l_linestatus) AS code, CAST(l_linenumber AS INT) AS level_no, CAST(3 * (l_orderkey % 81) AS INT) AS step_h,
  CAST(l_orderkey % 51 AS INT) AS number, CAST(o_orderdate AS TIMESTAMP) AS run_time, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  WINDOW o AS (PARTITION BY file ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice))""",
    "mapping": """mapping AS (SELECT DISTINCT attrs, code AS varname, 'isobaricInhPa' AS "typeOfLevel", CASE WHEN code[2] = 'o' THEN 'instant' ELSE 'accum' END AS "stepType", CAST(level_no * 100 AS DOUBLE) AS level, step_h AS map_step_h FROM msg WHERE level_no < 7)""",
    "cells": """cells AS (SELECT *, -12.0 + 3.5 * cell AS lat, 21.0 + 3.2 * cell AS lon FROM (SELECT event_type AS varname, CAST(user_id % 5 AS INT) AS member,
  CAST(3 * (date_diff('second', TIMESTAMP '2024-01-01', ts) // 10800) AS INT) AS step_h, CAST(CAST(json_extract_string(props, '$.k') AS INT) % 10 AS INT) AS cell, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value FROM events GROUP BY ALL))""",
    "dense": """dense AS (SELECT a.varname, a.member, a.step_h, a.cell, coalesce(c.value, CAST(0 AS DECIMAL(18,2))) AS value, -12.0 + 3.5 * a.cell AS lat, 21.0 + 3.2 * a.cell AS lon FROM (
  SELECT varname, CAST(s AS INT) AS step_h, CAST(m AS INT) AS member, CAST(k AS INT) AS cell FROM (SELECT DISTINCT varname FROM cells), (SELECT unnest(range(0, (SELECT max(step_h) + 1 FROM cells), 3)) AS s), (SELECT unnest(range(5)) AS m), (SELECT unnest(range(10)) AS k)) a
  LEFT JOIN cells c USING (varname, member, step_h, cell))""",
    "nans": """nans AS (SELECT * REPLACE (CASE WHEN (member + step_h // 3 + cell) % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(value AS DOUBLE) END AS value) FROM dense)""",
    "cum": """cum AS (SELECT * REPLACE (CAST(sum(value) OVER (PARTITION BY varname, member, cell ORDER BY step_h) AS DECIMAL(18,2)) AS value) FROM dense)""",
    "listing": """listing AS (SELECT o_orderkey AS file, printf('s3://bucket/gefs.%s/%02d/atmos/gep%02d.t00z.f%03d', strftime(o_orderdate, '%Y%m%d'), o_orderkey % 4 * 6, o_orderkey % 30 + 1, o_orderkey % 81 * 3) AS path,
  CAST(trunc(o_totalprice * 1000) AS BIGINT) AS size, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS has_idx, CAST(o_orderdate AS TIMESTAMP) AS run_time FROM orders)""",
}
_NEEDS = {"mapping": ["msg"], "dense": ["cells"], "nans": ["cells", "dense"], "cum": ["cells", "dense"]}


def with_views(sql: str, *names: str) -> str:
    """SQL with the named views in front of it."""
    wanted: list[str] = []
    for n in names:
        wanted += [x for x in [*_NEEDS.get(n, []), n] if x not in wanted]
    return "WITH " + ",\n".join(CTES[n] for n in wanted) + "\n" + sql
