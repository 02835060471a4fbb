"""Text and JSON index files as message tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import message_length
from ..schemas import MESSAGE_JSON


def index_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of the index files under a path, with the file each comes from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("idx_uri"))


def _checked(good: Column, line: Column) -> Column:
    return F.when(good, line).otherwise(F.raise_error(F.concat(F.lit("Could not parse line: "), F.coalesce(line, F.lit("null")))).cast("string"))


def read_idx(lines: DataFrame, file_sizes: DataFrame | None = None, key: str = "idx_uri") -> DataFrame:
    """`idx:offset:date:attrs` lines as messages. A line of another form fails the job.

    With `file_sizes` (key, file_size) the lengths are added, the last one up to the end of the file.
    """
    parts = F.split(_checked(F.col("value").rlike(r"^\d+:\d+:[^:]*:"), F.col("value")), ":", 4)
    rows = lines.select(key, F.get(parts, 0).cast("int").alias("idx"), F.get(parts, 1).cast("bigint").alias("offset"), F.get(parts, 2).alias("date"), F.get(parts, 3).alias("attrs"))
    return rows if file_sizes is None else message_length(rows.join(file_sizes, key), key)


def read_idx_json(lines: DataFrame, mode: str = "fail") -> DataFrame:
    """JSON lines (a trailing comma is allowed) with the archives' defaults for what is missing.

    A line that is no JSON object fails the job; in mode 'skip' it is left out (see `bad_json_lines`).
    """
    text = F.rtrim(F.trim("value"), F.lit(","))
    whole = F.try_parse_json(text).isNotNull() & text.startswith("{")
    keep = [c for c in lines.columns if c != "value"]
    good = lines.where(whole) if mode == "skip" else lines.withColumn("value", _checked(whole, F.col("value")))
    return good.select(*keep, F.from_json(text, MESSAGE_JSON).alias("m")).select(
        *keep, F.coalesce("m._offset", F.lit(0)).alias("offset"), F.coalesce("m._length", F.lit(0)).alias("length"), "m.param", "m.levtype", "m.levelist", "m.step",
        F.coalesce(F.expr("try_cast(m.number AS INT)"), F.lit(-1)).alias("number"), F.coalesce("m.date", F.lit("Unknown Date")).alias("date"), "m.time",
    )


def bad_json_lines(lines: DataFrame) -> DataFrame:
    text = F.rtrim(F.trim("value"), F.lit(","))
    whole = F.try_parse_json(text).isNotNull() & text.startswith("{")
    return lines.agg(F.count("*").alias("n_lines"), F.count_if(~F.coalesce(whole, F.lit(False))).alias("n_broken"))


def _lenient(lines: DataFrame) -> DataFrame:
    field = lambda n, kind: F.expr(f"try_cast(get(split(value, ':'), {n}) AS {kind})")
    return lines.withColumns({"fields": F.size(F.split("value", ":")), "record": field(0, "INT"), "offset": field(1, "BIGINT")})


def read_idx_lenient(lines: DataFrame) -> DataFrame:
    """`record:offset:date:var:level:forecast`; short and non-integer lines are left out. Count them with `bad_lines`.

    Other columns, such as a file and `line_num`, stay.
    """
    parts = F.split("value", ":")
    keep = [c for c in lines.columns if c != "value"]
    return _lenient(lines).where("fields >= 6 AND record IS NOT NULL AND offset IS NOT NULL").select(*keep, "record", "offset", *(F.get(parts, n).alias(c) for n, c in ((2, "date"), (3, "varname"), (4, "level"), (5, "forecast"))))


def bad_lines(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines in all, short ones, and long ones without a whole number for record or offset; by `keys`, if asked."""
    number = F.col("record").isNull() | F.col("offset").isNull()
    return _lenient(lines).groupBy(*keys).agg(F.count("*").alias("n_lines"), F.count_if(F.col("fields") < 6).alias("n_short"), F.count_if((F.col("fields") >= 6) & number).alias("n_not_integer"))
