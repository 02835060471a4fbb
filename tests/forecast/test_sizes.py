"""Tasks that do not grow with the tables."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brume.operators import store as R
from brume.plans import catalog
from brume.plans import views as V
from brume.sources import stores as O

DATA = Path("/root/testdata/sf0.001")
with_tables = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@with_tables
def test_messages_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(V, "ROWS_A_TASK", 500, raising=False)
    m = V.msg_index(spark, str(DATA))
    rows = [r["count"] for r in m.groupBy(F.spark_partition_id()).count().collect()]
    whole = V.table(spark, str(DATA), "lineitem").count()
    assert sum(rows) == whole and len(rows) > 4 and max(rows) < 1500


@with_tables
@pytest.mark.parametrize("name", ["fmrc_horizon", "variable_inventory", "axis_lookup"])
def test_messages_meet_a_template_of_known_size(spark, name):
    """No join of a message table with the template shuffles the messages by their few attrs."""
    assert "hashpartitioning(attrs" not in planned(catalog.queries()[name](spark, str(DATA)))


def test_a_key_of_many_hours_is_merged_before_it_moves(spark):
    hours = spark.range(1000).select(F.lit(1).alias("member"), F.lit("a").alias("key"), (F.col("id") % 500).cast("int").alias("forecast_hour"), F.format_string("f%04d", "id").alias("uri"), F.col("id").alias("offset"), F.lit(None).cast("bigint").alias("length"))
    last = O.load_member_hours(hours)
    assert [tuple(r) for r in last.collect()] == [(1, "a", 499, "f0999", 999, None)]
    assert last.columns == hours.columns and "Window" not in planned(last)


def test_chunks_are_not_regrouped(spark):
    """Chunks of arrays of different dims stay one row each, in as many tasks as asked for; a dim more than the array has fails."""
    refs = spark.createDataFrame([("a/1.0", 5), ("b/0", 6), ("c/0", 7)], "key STRING, offset LONG").withColumns({"uri": F.lit("u"), "length": F.lit(1).cast("bigint")})
    coords = spark.createDataFrame([("a", "time", 1, 100), ("a", "step", 0, 3), ("b", "time", 0, 200)], "path STRING, dim STRING, i INT, coord LONG")
    arrays = spark.createDataFrame([("a", 0, "time", 1, 2), ("a", 1, "step", 1, 1), ("b", 0, "time", 1, 1), ("c", 0, "cell", 5, 5)], "path STRING, pos INT, dim STRING, chunk_size INT, size INT")
    out = R.extract_chunk_index(refs, coords, arrays, 7)
    assert {r.key: r["at"] for r in out.collect()} == {"a/1.0": {"time": 100, "step": 3}, "b/0": {"time": 200}, "c/0": None}
    assert "collect_list" not in planned(out) and "hashpartitioning(path" in planned(out)
    with pytest.raises(Exception, match="no rule for a dim"):
        R.extract_chunk_index(refs.withColumn("key", F.concat("key", F.lit(".0"))), coords, arrays).collect()
    with pytest.raises(Exception, match="two coordinates"):
        R.extract_chunk_index(refs, coords.unionByName(coords), arrays).collect()


def test_one_chunk_of_a_time_and_step_meets_the_axes(spark):
    placed = spark.createDataFrame([(i, 3, "p", "v", 0, [500.0], f"u{9 - i % 10}", i, 1) for i in range(100)], "time INT, step_h INT, path STRING, varname STRING, k LONG, levels ARRAY<DOUBLE>, uri STRING, offset LONG, length LONG").withColumns({"time": F.col("time") * 0, "valid_time": F.col("time")})
    axes = spark.createDataFrame([(a, 0, 3, [0]) for a in ("x", "y")], "axis STRING, time INT, step_h INT, place ARRAY<LONG>")
    out = R.store_chunks(axes, placed)
    assert sorted((r.axis, r.key, r.uri, r.offset) for r in out.collect()) == [(a, "p/v/0.0.0", "u0", 9) for a in ("x", "y")]
    assert planned(out).count("min_by") >= 4  # before the join and after it


@with_tables
@pytest.mark.parametrize("name", ["dedupe_attrs", "fmrc_horizon", "select_variables", "step_position", "unique_groups", "variable_inventory", "message_length", "chunk_ref_kind", "local_time_window", "mapper", "max_hour"])
def test_queries_sort_messages_as_dealt(spark, monkeypatch, name):
    """Messages are sorted in partitions that grow with their rows, not in the shuffle's fixed number of them."""
    monkeypatch.setattr(V, "ROWS_A_TASK", 500, raising=False)
    plan = planned(catalog.queries()[name](spark, str(DATA)))
    n = -(-sum(V.table(spark, str(DATA), t).count() for t in ("lineitem", "orders")) // 500)
    assert n > 4 and re.search(rf"hashpartitioning\(l_orderkey#\d+L?, {n}\), REPARTITION_BY_NUM", plan)
    assert not re.search(r"hashpartitioning\((l_orderkey|file)#\d+L?(, attrs#\d+)?, \d+\), ENSURE_REQUIREMENTS", plan)
