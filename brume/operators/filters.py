"""Predicates on messages, cells and files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.project import extract
from ..schemas import PRESSURE_LEVELS, REGIONS, SOIL_LEVELS


def match_attrs(messages: DataFrame, patterns: DataFrame, regex: bool = False) -> DataFrame:
    """For each pattern the first message of each file whose attrs match, counted from 0; 9999 if there is none.

    Patterns are a caller's short list: they are gathered in one row, and each message tests it in place.
    """
    listed = patterns.select("pattern").distinct().agg(F.sort_array(F.collect_list("pattern")).alias("patterns"))  # one row
    fits = (lambda p: F.col("attrs").rlike(p)) if regex else (lambda p: F.contains(F.col("attrs"), p))
    met = messages.select("file", "idx", "attrs").crossJoin(F.broadcast(listed))
    hits = met.select("file", "idx", F.explode(F.filter("patterns", fits)).alias("pattern"))
    first = hits.groupBy("file", "pattern").agg((F.min("idx") - 1).alias("position"))
    grid = messages.select("file").distinct().crossJoin(F.broadcast(listed)).select("file", F.explode("patterns").alias("pattern"))
    return grid.join(first, ["file", "pattern"], "left").withColumn("position", F.coalesce("position", F.lit(9999)))


def filter_member(df: DataFrame, member: int | str, column: str = "member") -> DataFrame:
    return df.where(F.col(column) == member)


def select_levels(df: DataFrame) -> DataFrame:
    """Pressure levels and soil layers of interest, and all surface fields."""
    level = F.expr("try_cast(levelist AS INT)")
    pl, sol = (F.col("levtype") == "pl") & level.isin(PRESSURE_LEVELS), (F.col("levtype") == "sol") & level.isin(SOIL_LEVELS)
    return df.where(pl | sol | (F.col("levtype") == "sfc")).withColumn("levelist", F.coalesce("levelist", F.lit("null")))


def parse_targets(codes: DataFrame) -> DataFrame:
    """`t:pl:850` or `t:sfc` short codes as param, levtype, levelist ('null' for none)."""
    parts = F.split("code", ":")
    return codes.select(F.get(parts, 0).alias("param"), F.get(parts, 1).alias("levtype"), F.coalesce(F.get(parts, 2), F.lit("null")).alias("levelist"))


def select_targets(messages: DataFrame, codes: DataFrame) -> DataFrame:
    return messages.withColumn("levelist", F.coalesce("levelist", F.lit("null"))).join(parse_targets(codes), ["param", "levtype", "levelist"], "left_semi")


def crop_region(cells: DataFrame, region: str | tuple[float, float, float, float]) -> DataFrame:
    south, north, west, east = REGIONS[region] if isinstance(region, str) else region
    return cells.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))


def select_steps(cells: DataFrame, targets: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """For each target hour the nearest step within a tolerance (the earlier of two); null where none is near.

    Hours are dealt to bins of the tolerance's width, so near ones lie in the same or the next bin.
    """
    bin_of = lambda c: F.floor(F.col(c) / tolerance).cast("long")
    steps = cells.select("step_h").distinct().withColumn("bin", bin_of("step_h"))
    asked = targets.withColumn("bin", F.explode(F.sequence(bin_of("target_h") - 1, bin_of("target_h") + 1)))
    distance = F.abs(F.col("step_h") - F.col("target_h"))
    near = F.when(distance < tolerance, F.struct(distance.alias("d"), "step_h"))
    return asked.join(steps, "bin", "left").groupBy("target_h").agg(F.min(near)["step_h"].alias("step_h"))


def select_pressure(df: DataFrame, levels: list[int]) -> DataFrame:
    return df.where(F.col("level_no").isin(levels)).withColumn("field", F.format_string("%s_%d", "code", "level_no"))


def strip_chunks(refs: DataFrame) -> DataFrame:
    """Metadata and coordinates only: chunk keys go, but for latitude and longitude."""
    path = extract(F.col("key"), r"^(.*)/\d+[\d.]*$")
    return refs.where(path.isNull() | path.rlike("(latitude|longitude)$"))


def drop_unmapped(df: DataFrame, name: str = "mapped") -> DataFrame:
    """Rows with a variable. The rows dropped are counted as an observed metric `<name>`."""
    return df.observe(name, F.count_if(F.col("varname").isNull()).alias("unmapped"), F.count("*").alias("rows")).where("varname IS NOT NULL")


def select_variables(df: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the wanted variables, the names that are missing)."""
    return df.join(wanted, "varname", "left_semi"), wanted.join(df.select("varname").distinct(), "varname", "left_anti")


def size_outliers(files: DataFrame, size: str = "size") -> DataFrame:
    """Files outside mean +- standard deviation (n - 1) of all sizes."""
    s = F.col(size).cast("double")
    bounds = files.agg(F.avg(s).alias("m"), F.stddev_samp(s).alias("d"))
    return files.crossJoin(F.broadcast(bounds)).where((s < F.col("m") - F.col("d")) | (s > F.col("m") + F.col("d"))).drop("m", "d")


def spot_check_sample(messages: DataFrame, n: int, seed: int = 42, least: int = 10_000) -> DataFrame:
    """A reproducible sample of n messages longer than `least` bytes."""
    return messages.where(F.col("length") > least).orderBy(F.md5(F.concat_ws(":", F.lit(seed), "file", "idx")), "file", "idx").limit(n)


def valid_numeric(df: DataFrame, column: str = "value") -> DataFrame:
    v = F.col(column)
    return df.withColumn(column, F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")) | (v < 0), 0.0).otherwise(v))


def monthly_sample_dates(dates: DataFrame, seed: int = 42, date: str = "date") -> DataFrame:
    """One day of each month that occurs, chosen by a seeded hash."""
    months = dates.select(F.trunc(F.col(date), "month").alias("month")).distinct()
    days = F.day(F.last_day("month"))
    pick = F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.date_format("month", "yyyy-MM"))), 1, 8), 16, 10).cast("bigint"), days).cast("int")
    return months.select("month", F.date_add("month", pick).alias("sample"))


def max_hour(df: DataFrame, hour: int, column: str = "step_h") -> DataFrame:
    return df.where(F.col(column) <= hour)
