"""Set operations on members, stores and hours."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat_members(parts: dict[int, DataFrame]) -> DataFrame:
    """Member tables stacked, with a member column; columns that some lack are null."""
    tagged = [df.withColumn("member", F.lit(m)) for m, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def common_variables(cells: DataFrame) -> DataFrame:
    """Variables that every member has."""
    members = cells.agg(F.count_distinct("member").alias("n"))
    return cells.groupBy("varname").agg(F.count_distinct("member").alias("k")).crossJoin(F.broadcast(members)).where("k = n").select("varname", "k")


def split_recombine(df: DataFrame, names: list[str], process) -> DataFrame:
    """Rows of the named variables go through `process`, the others stay."""
    listed = F.col("varname").isin(names)
    return process(df.where(listed)).unionByName(df.where(~listed))


def hybrid_refs(scanned: DataFrame, indexed: DataFrame) -> DataFrame:
    """References of the scanned hours, and those of the other hours from the index."""
    hours = indexed.select("step_h").distinct().exceptAll(scanned.select("step_h").distinct())
    return scanned.unionByName(indexed.join(hours, "step_h", "left_semi"))


def keyset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys on one side only, and whether the sets are equal."""
    only_a = a.select("key").exceptAll(b.select("key")).agg(F.count("*").alias("only_a"))
    only_b = b.select("key").exceptAll(a.select("key")).agg(F.count("*").alias("only_b"))
    common = a.select(F.get(F.split("key", "/"), 0).alias("p")).intersect(b.select(F.get(F.split("key", "/"), 0).alias("p"))).agg(F.count("*").alias("common_prefixes"))
    return only_a.crossJoin(only_b).crossJoin(common).withColumn("equal", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def grid_fingerprints(cells: DataFrame, by: str, grid: tuple[str, ...] = ("lat", "lon")) -> DataFrame:
    """What tells the sets of points of several grids apart, whatever the order of their rows: count, xor and sum of hashes.

    Each point is hashed twice, so that equal points of one grid must be made different first; hashing merges in partial
    aggregates, and only one row for each grid moves on.
    """
    one, two = F.xxhash64(*grid), F.xxhash64(F.lit(1), *grid)
    return cells.select(by, *grid).distinct().groupBy(by).agg(F.count("*").alias("points"), F.bit_xor(one).alias("xor_hash"), F.sum(two.bitwiseAND(0xFFFFFFFF)).alias("sum_hash"))


def combine_hours(parts: list[DataFrame], grid: tuple[str, ...] = ("lat", "lon")) -> DataFrame:
    """Tables of several hours as one; a table with another grid (other points, be they as many) is an error when rows are read. Empty tables have no grid."""
    both = reduce(lambda a, b: a.unionByName(b), parts)
    numbered = reduce(lambda a, b: a.unionByName(b), [p.select(*grid, F.lit(i).alias("_part")) for i, p in enumerate(parts)])
    checked = grid_fingerprints(numbered, "_part", grid).agg(F.count_distinct(F.struct("points", "xor_hash", "sum_hash")).alias("grids"))
    fine = F.when(F.col("grids") <= 1, True).otherwise(F.raise_error(F.lit("the grids differ")).cast("boolean"))
    return both.crossJoin(F.broadcast(checked)).where(fine).drop("grids")
