"""Features for machine learning from ensemble cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import real
from .windows import place_on_axis


def norm_stats(cells: DataFrame) -> DataFrame:
    """mean, std, min and max of each variable."""
    v = real()
    return cells.groupBy("varname").agg(F.round(F.avg(v), 6).alias("f_mean"), F.round(F.stddev_pop(v), 6).alias("f_std"), F.min(v).alias("f_min"), F.max(v).alias("f_max"))


def normalize_field(cells: DataFrame, stats: DataFrame, kinds: dict[str, str], columns: tuple[str, ...] = ("value",)) -> DataFrame:
    """Values by kind: log (log10(1 + max(x, 0))), standard, max, symmetric; unchanged without kind or statistics."""
    kind = F.coalesce(F.create_map(*(F.lit(x) for kv in kinds.items() for x in kv))[F.col("varname")], F.lit("none"))
    joined = cells.join(stats, "varname", "left").withColumn("kind", kind)
    for c in columns:
        x = F.col(c).cast("double")
        out = (
            F.when(F.col("kind") == "log", F.log10(1 + F.greatest(x, F.lit(0.0))))
            .when((F.col("kind") == "standard") & (F.col("f_std") > 0), (x - F.col("f_mean")) / F.col("f_std"))
            .when((F.col("kind") == "max") & (F.col("f_max") != 0), x / F.col("f_max"))
            .when((F.col("kind") == "symmetric") & (F.greatest(F.abs("f_min"), F.abs("f_max")) > 0), x / F.greatest(F.abs("f_min"), F.abs("f_max")))
            .otherwise(x)
        )
        joined = joined.withColumn(c, F.round(out, 6))
    return joined.drop("kind", "f_mean", "f_std", "f_min", "f_max")


def four_channel(stats: DataFrame, pairs: DataFrame) -> DataFrame:
    """[mean_1, std_1, mean_2, std_2] of each variable, cell and pair of steps (step_1, step_2)."""
    a = stats.select("varname", "cell", F.col("step_h").alias("step_1"), F.col("mean").alias("mean_1"), F.col("std").alias("std_1"))
    b = stats.select("varname", "cell", F.col("step_h").alias("step_2"), F.col("mean").alias("mean_2"), F.col("std").alias("std_2"))
    return pairs.join(a, "step_1").join(b, ["varname", "cell", "step_2"])


def feature_tensor(channels: DataFrame, fields: list[str]) -> DataFrame:
    """One array per pair and cell: four channels for each field in a fixed order; absent fields are left out."""
    four = F.struct(*(F.col(c) for c in ("mean_1", "std_1", "mean_2", "std_2")))
    wide = channels.groupBy("step_1", "step_2", "cell").pivot("varname", fields).agg(F.first(four))
    part = lambda f: F.when(F.col(f).isNotNull(), F.array(*(F.col(f"`{f}`.{c}") for c in ("mean_1", "std_1", "mean_2", "std_2")))).otherwise(F.array().cast("array<double>"))
    return wide.select("step_1", "step_2", "cell", F.concat(*map(part, fields)).alias("features"))


def restructure(cells: DataFrame) -> DataFrame:
    """Cells with the place of their step among those of their variable."""
    return place_on_axis(cells, "step_h", "time_index").select("varname", F.col("member").alias("ensemble"), "time_index", "cell", "value")


def input_state(cells: DataFrame) -> DataFrame:
    """Map field name -> values by cell, for each step and member."""
    grids = cells.groupBy("step_h", "member", "varname").agg(F.array_sort(F.collect_list(F.struct("cell", "value"))).alias("g"))
    return grids.groupBy("step_h", "member").agg(F.map_from_entries(F.collect_list(F.struct("varname", F.transform("g", lambda x: x["value"])))).alias("fields"))


def extract_all_steps(cells: DataFrame, varname: str, steps: DataFrame) -> DataFrame:
    """All cells of a variable at the wanted steps; a step that is not there is one row with `missing`."""
    own = cells.where(F.col("varname") == varname)
    return steps.join(own, "step_h", "left").withColumn("missing", F.col("varname").isNull())
