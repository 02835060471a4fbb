"""Joins of indexes, templates, stores and grids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.project import valid_time
from ..schemas import CHUNK_INDEX
from .windows import dedupe_attrs, dedupe_largest


def small(df: DataFrame, rows: int | None, limit: int = 500_000) -> DataFrame:
    """Broadcast a side whose rows were counted and are few; else Spark chooses by its statistics."""
    return F.broadcast(df) if rows is not None and rows <= limit else df


Mapper = Callable[[DataFrame], DataFrame]


def mapped(messages: DataFrame, mapper: Mapper | None) -> DataFrame:
    """Messages as a caller's function leaves them; it must keep their columns."""
    if mapper is None:
        return messages
    out = messages.transform(mapper)
    if set(messages.columns) - set(out.columns):
        raise ValueError("the mapper has dropped columns")
    return out


def build_mapping(index: DataFrame, grib: DataFrame) -> DataFrame:
    """Index rows with the metadata of their message (by uri and idx); the index's offset and length count.

    `consistent`: both agree, or there is no metadata, or the value is inline.
    """
    g = grib.withColumnRenamed("offset", "offset_grib").withColumnRenamed("length", "length_grib")
    same = (F.col("offset") == F.col("offset_grib")) & (F.col("length") == F.col("length_grib"))
    return index.join(g, ["uri", "idx"], "left").withColumn("consistent", F.col("offset_grib").isNull() | F.col("inline_value").isNotNull() | same)


def map_from_index(index: DataFrame, mapping: DataFrame, keys: tuple[str, ...] = ("attrs",), mapping_rows: int | None = None) -> DataFrame:
    """The chunk index of any number of runs: offsets from the index, variable, level and step from the template.

    `index`: one row per attrs and file (see `dedupe_attrs`); `mapping`: one row per key. Unmapped messages go.
    """
    joined = index.drop("step_h").join(small(mapping.withColumnRenamed("map_step_h", "step_h"), mapping_rows), list(keys))
    timed = valid_time(joined.withColumn("time", F.col("run_time")), "time")
    for name in CHUNK_INDEX:
        if name not in timed.columns:
            timed = timed.withColumn(name, F.lit(None).cast("timestamp_ntz" if name.endswith("_at") else "string"))
    return timed.select(*CHUNK_INDEX, *(c for c in ("file", "idx") if c in timed.columns))


def mapped_index_run(index: DataFrame, mapping: DataFrame, conditions: DataFrame, mapping_rows: int | None = None, mapper: Mapper | None = None) -> DataFrame:
    """All files of all runs in one job: first message per attrs, template, largest message per variable and time.

    `mapper`: a caller's own function on the messages before anything else is done with them.
    """
    return dedupe_largest(map_from_index(dedupe_attrs(mapped(index, mapper)), mapping, mapping_rows=mapping_rows), conditions)


def mapping_run(index: DataFrame, grib: DataFrame) -> DataFrame:
    """Templates of every file: metadata joined and one row per attrs."""
    return dedupe_attrs(build_mapping(index, grib))


def overlay_template(fresh: DataFrame, template: DataFrame) -> DataFrame:
    """Fresh references over a template's, by key; fresh keys that start with `_` are left out."""
    f = fresh.where(~F.col("key").startswith("_")).select("key", F.col("value").alias("fresh"))
    t = template.select("key", F.col("value").alias("template"))
    return f.join(t, "key", "full_outer").select("key", F.coalesce("fresh", "template").alias("value"), F.when(F.col("fresh").isNotNull(), "fresh").otherwise("template").alias("source"))


def axis_lookup(axis: DataFrame, chunks: DataFrame, on: tuple[str, ...] = ("time", "step_h", "level"), mode: str = "report") -> DataFrame:
    """Chunk of each cell of an axis; cells without one keep nulls. `matches` over 1 is an error in mode 'fail'."""
    found = chunks.groupBy(*on).agg(F.count("*").alias("matches"), F.min_by(F.struct("uri", "offset", "length"), F.struct("uri", "offset")).alias("c"))
    out = axis.join(found, list(on), "left").select(*axis.columns, "c.uri", "c.offset", "c.length", F.coalesce("matches", F.lit(0)).alias("matches"))
    if mode == "fail":
        out = out.withColumn("matches", F.when(F.col("matches") <= 1, F.col("matches")).otherwise(F.raise_error(F.lit("more than one chunk for a cell")).cast("bigint")))
    return out


def semi_groups(store: DataFrame, chunks: DataFrame) -> DataFrame:
    return store.join(chunks.select("varname", "stepType", "typeOfLevel").distinct(), ["varname", "stepType", "typeOfLevel"], "left_semi")


def ensemble_key_join(messages: DataFrame, keys: DataFrame) -> DataFrame:
    """Messages with the ensemble key of their (param, levtype, levelist, number); null-safe, the last key wins."""
    on = [F.col(f"m.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("param", "levtype", "levelist", "number")]
    cond = on[0] & on[1] & on[2] & on[3]
    last = keys.groupBy("param", "levtype", "levelist", "number").agg(F.max("ensemble_key").alias("ensemble_key"))
    return messages.alias("m").join(last.alias("k"), cond).select("m.*", "k.ensemble_key")


def member_cross(params: DataFrame, members: int) -> DataFrame:
    """Every parameter for every member, with its ensemble key; the control is -1."""
    spread = params.withColumn("number", F.explode(F.sequence(F.lit(-1), F.lit(members - 2))))
    return spread.withColumn("ensemble_key", F.concat(F.concat_ws("_", "param", "levtype", "levelist"), F.lit("_ens"), F.col("number").cast("string")))


def attach_member(groups: DataFrame, members: DataFrame) -> DataFrame:
    """Message groups with their member (-1 if unknown), and the list of idx per file and member."""
    return groups.join(members, ["file", "idx"], "left").withColumn("number", F.coalesce("number", F.lit(-1))).groupBy("file", "number").agg(F.sort_array(F.collect_list("idx")).alias("idx_list"))


def anti_existing(planned: DataFrame, existing: DataFrame, key: str = "path") -> DataFrame:
    return planned.join(existing.select(key).distinct(), key, "left_anti")


def file_pairs(expected: DataFrame, data: DataFrame, index: DataFrame) -> DataFrame:
    """Expected files with what is there of data (file, size) and index (file)."""
    d, i = data.select("file", (F.round(F.col("size") / 1048576, 2)).alias("grb2_size_mb"), F.lit(True).alias("g")), index.select("file", F.lit(True).alias("i")).distinct()
    out = expected.join(d, "file", "left").join(i, "file", "left").withColumns({"grb2_exists": F.coalesce("g", F.lit(False)), "idx_exists": F.coalesce("i", F.lit(False))})
    return out.withColumn("both_exist", F.col("grb2_exists") & F.col("idx_exists")).drop("g", "i")


def _value_before(cells: DataFrame, window: int) -> DataFrame:
    """Each cell with `start`, its value exactly `window` hours before: one window, no self join."""
    span = Window.partitionBy("varname", "member", "cell").orderBy("step_h").rangeBetween(-window, -window)
    return cells.select("varname", "member", "cell", "step_h", "value", F.max("value").over(span).alias("start"))


def diff_24h(cells: DataFrame, window: int = 24) -> DataFrame:
    """24-hour totals from totals since the start: max(0, end - start). Without any pair, the values as they are."""
    ends = _value_before(cells, window)
    flag = F.broadcast(ends.agg((F.count("start") == 0).alias("none")))  # one row
    total = F.when(F.col("none"), F.col("value")).otherwise(F.greatest(F.col("value") - F.col("start"), F.lit(0)))
    return ends.crossJoin(flag).where("none OR start IS NOT NULL").select("varname", "member", "cell", "step_h", total.alias("total"))


def precip_window(cells: DataFrame, window: int) -> DataFrame:
    """Total of the last `window` hours, from the start of the run for the first ones; null where the step that it starts from is missing."""
    whole = F.col("step_h") <= window
    part = F.when(F.col("start").isNotNull(), F.greatest(F.col("value") - F.col("start"), F.lit(0)))
    return _value_before(cells, window).select("varname", "member", "cell", "step_h", F.when(whole, F.col("value")).otherwise(part).alias("total"))


def nearest_run(targets: DataFrame, runs: DataFrame, on: str, target: str = "target_date", run: str = "run_date", bucket_days: int = 256) -> DataFrame:
    """For each target date of a key the nearest run of that key (the later of two); the key's last run without a date.

    Different runs and targets of a key are put in order within buckets of days, so a task orders at most two rows for each day
    of a bucket however hot a key is. The last and first run of each bucket are carried to the others in a table of
    one row for each key and bucket (a date type has fewer than 46,000 buckets of 256 days). A null key is a key of its own.
    """
    both = targets.select(F.col(on).alias("_key"), F.col(target).alias("day"), F.lit(None).cast("date").alias("run"), F.lit(True).alias("asks"))
    both = both.unionByName(runs.select(F.col(on).alias("_key"), F.col(run).alias("day"), F.col(run).alias("run"), F.lit(False).alias("asks"))).distinct()
    both = both.withColumn("bucket", F.floor(F.datediff("day", F.lit("1970-01-01").cast("date")) / bucket_days))
    edges = both.groupBy("_key", "bucket").agg(F.min("run").alias("first"), F.max("run").alias("final"))
    of_key = Window.partitionBy("_key").orderBy("bucket")
    carried = edges.select(
        F.col("_key").alias("_k"), F.col("bucket").alias("_b"),
        F.last("final", True).over(of_key.rowsBetween(Window.unboundedPreceding, -1)).alias("came"),
        F.first("first", True).over(of_key.rowsBetween(1, Window.unboundedFollowing)).alias("comes"),
        F.max("final").over(Window.partitionBy("_key")).alias("last"),
    )
    by_day = Window.partitionBy("_key", "bucket").orderBy("day", "asks")
    before = F.last("run", True).over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("run", True).over(by_day.rowsBetween(0, Window.unboundedFollowing))
    near = both.select("_key", "bucket", "day", "asks", before.alias("before"), after.alias("after")).where("asks")
    met = near.join(carried, F.col("_key").eqNullSafe(F.col("_k")) & F.col("bucket").eqNullSafe(F.col("_b")))
    met = met.withColumns({"before": F.coalesce("before", "came"), "after": F.coalesce("after", "comes")})
    nearer = F.col("before").isNull() | (F.datediff("after", "day") <= F.datediff("day", "before"))
    return met.select(F.col("_key").alias(on), F.col("day").alias(target), F.when(F.col("day").isNull(), F.col("last")).when(nearer, F.coalesce("after", "before")).otherwise(F.col("before")).alias(run))


def align_grids(a: DataFrame, b: DataFrame, on: tuple[str, ...] = ("varname", "step_h", "cell")) -> DataFrame:
    """Values of two grids side by side; a missing side is null."""
    return a.select(*on, F.col("value").alias("a")).join(b.select(*on, F.col("value").alias("b")), list(on), "full_outer")


def grid_mismatch(aligned: DataFrame) -> DataFrame:
    return aligned.agg(F.count_if(F.col("a").isNull()).alias("only_b"), F.count_if(F.col("b").isNull()).alias("only_a"), F.count("*").alias("cells"))


def align_steps(cells: DataFrame) -> DataFrame:
    """All variables at their common steps (at all steps, if none is common); missing values are null."""
    steps = cells.groupBy("step_h").agg(F.count_distinct("varname").alias("k"))
    names = cells.select("varname").distinct()
    most = steps.agg(F.max("k").alias("most")).crossJoin(names.agg(F.count("*").alias("n")))  # one row
    axis = steps.crossJoin(F.broadcast(most)).where("k = n OR most < n").select("step_h")
    first = cells.groupBy("varname", "step_h").agg(F.sum("value").alias("value"))
    return axis.crossJoin(names).join(first, ["varname", "step_h"], "left")


def nearest_step_pair(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each (h1, h2) the nearest steps (the earlier of two), whatever their distance.

    The steps of an axis are gathered once, in order, and each pair looks its own up in that one row.
    """
    axis = cells.agg(F.sort_array(F.collect_set("step_h")).alias("steps"))  # one row
    near = lambda h: F.array_min(F.transform("steps", lambda s: F.struct(F.abs(s - F.col(h)).alias("d"), s.alias("s"))))["s"]
    return pairs.crossJoin(F.broadcast(axis)).select("h1", "h2", near("h1").alias("step_1"), near("h2").alias("step_2"))
