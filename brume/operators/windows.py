"""Window logic on message tables. Every order has a total tie-break."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def message_length(df: DataFrame, file: str = "file") -> DataFrame:
    """`length` = next offset - offset; the last message ends with its file (`file_size`)."""
    after = F.lead("offset").over(Window.partitionBy(file).orderBy("idx"))
    return df.withColumn("length", F.coalesce(after, F.col("file_size")) - F.col("offset"))


def dedupe_largest(df: DataFrame, conditions: DataFrame, keys: tuple[str, ...] = ("varname", "typeOfLevel", "time")) -> DataFrame:
    """The largest message for each key of the listed (varname, typeOfLevel); other variables stay as they are.

    Listed variables at other level types are dropped. Ties go to the lower idx, then the uri. One join and one window:
    rows of other variables go through the window, but their rank does not count.
    """
    levels = conditions.groupBy("varname").agg(F.collect_set("typeOfLevel").alias("_levels"))
    marked = df.join(levels, "varname", "left").where(F.col("_levels").isNull() | F.array_contains("_levels", F.col("typeOfLevel")))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("length"), "idx", "uri"))
    return marked.withColumn("_n", rank).where("_n = 1 OR _levels IS NULL").drop("_n", "_levels")


def dedupe_attrs(df: DataFrame, keys: tuple[str, ...] = ("file", "attrs")) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("idx"))
    return df.withColumn("n", rank).where("n = 1").drop("n")


def place_on_axis(df: DataFrame, column: str, name: str, key: str = "varname") -> DataFrame:
    """`name`: place of a row's value among the different values of its key; only these are ranked."""
    axis = df.select(key, column).distinct()
    ranked = axis.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(column)) - 1)
    return df.join(ranked, [key, column])


def step_position(df: DataFrame) -> DataFrame:
    return place_on_axis(df, "step_h", "position")


def hour_index(df: DataFrame, hour: str = "step_h", mode: str = "fail") -> DataFrame:
    """Position of a forecast hour on the 3-hourly (to 144) and 6-hourly (150 to 360) axis.

    An hour that is on neither fails the job; in mode 'null' its position is null.
    """
    h = F.col(hour)
    early = (h >= 0) & (h <= 144) & (h % 3 == 0)
    late = (h >= 150) & (h <= 360) & ((h - 150) % 6 == 0)
    other = F.lit(None).cast("int") if mode == "null" else F.raise_error(F.concat(F.lit("no forecast hour of the axis: "), F.coalesce(h.cast("string"), F.lit("null")))).cast("int")
    return df.withColumn("hour_index", F.when(early, (h / 3).cast("int")).when(late, (49 + (h - 150) / 6).cast("int")).otherwise(other))


def latest_run(df: DataFrame, run: str = "run_time", keys: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(run).alias("latest_run"), F.max_by("uri", F.struct(run, "uri")).alias("latest_uri"))


def first_variable_rows(df: DataFrame) -> DataFrame:
    """The first row of each variable by file and idx."""
    rest = [c for c in df.columns if c != "varname"]
    return df.groupBy("varname").agg(F.min_by(F.struct(*rest), F.struct("file", "idx")).alias("r")).select("varname", "r.*")


def sort_index(df: DataFrame, time: str = "time") -> DataFrame:
    return df.orderBy(time, "varname", "file", "idx")


def member_files_sorted(files: DataFrame, member: str) -> DataFrame:
    return files.where(F.col("member") == member).orderBy("forecast_hour", "path")


def top_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def first_n_members(df: DataFrame, n: int, member: str = "member") -> DataFrame:
    return df.select(member).distinct().orderBy(member).limit(n)
