"""Row expressions: paths, keys, members, units, times. All are JVM-side columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ACCUMULATED, COORDINATES, GRAVITY, LEVEL_NAMES


def extract(path: Column, pattern: str, group: int = 1) -> Column:
    """A regular expression's group, null where it does not match."""
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def parse_url(df: DataFrame, path: str = "path") -> DataFrame:
    """date, run, member and forecast_hour of an object path; null where the path has none."""
    p = F.col(path)
    return df.withColumns({
        "date": extract(p, r"\.(\d{8})/"), "run": extract(p, r"\.\d{8}/(\d{2})/"), "member": extract(p, r"/(ge[cp]\d{2}|ens\d{2}|control)\."),
        "forecast_hour": F.expr(f"try_cast(nullif(regexp_extract({path}, '[.]f([0-9]{{3}})$', 1), '') AS INT)"),
    })


def model_run(refs: DataFrame, uri: str = "uri") -> DataFrame:
    """The first run (date, hour) named in any reference."""
    found = refs.select(extract(F.col(uri), r"/(\d{8}/\d{2})z/").alias("run"))
    return found.agg(F.min("run").alias("r")).select(F.substring("r", 1, 8).alias("run_date"), F.substring("r", 10, 2).alias("run_hour"))


def hours(column: Column) -> Column:
    return F.make_dt_interval(hours=column)


def valid_time(df: DataFrame, run_time: str = "run_time", step: str = "step_h") -> DataFrame:
    return df.withColumn("valid_time", F.col(run_time) + hours(F.col(step)))


def standardize_index(df: DataFrame) -> DataFrame:
    """Index rows with common names; step and level are numbers, 0 where they are none.

    Forecast hour (`-<h>h-`) and date (`/<yyyyMMdd>...`) come from the path; `time` is the run's, `valid_time` the step later.
    A table without one of the needed columns is an error.
    """
    missing = {"param", "levtype", "levelist", "step", "uri", "offset", "length"} - set(df.columns)
    if missing:
        raise ValueError(f"the index lacks {', '.join(sorted(missing))}")
    named = df.select(
        F.col("param").alias("varname"), F.col("levtype").alias("typeOfLevel"), F.coalesce(F.expr("try_cast(levelist AS DOUBLE)"), F.lit(0.0)).alias("level"),
        F.lit("instant").alias("stepType"), F.coalesce(F.expr("try_cast(step AS INT)"), F.lit(0)).alias("step_h"), F.coalesce(F.expr("try_cast(regexp_extract(uri, '-([0-9]+)h-', 1) AS INT)"), F.lit(0)).alias("forecast_hour"),
        F.try_to_timestamp(extract(F.col("uri"), r"/(\d{8})(?:\d{6})?-"), F.lit("yyyyMMdd")).cast("timestamp_ntz").alias("time"), "uri", "offset", "length",
    )
    return valid_time(named, "time")


def standardize_index_cf(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """CF names and level types; accumulated fields by parameter."""
    cf = F.create_map(*(F.lit(x) for kv in (names or {"": ""}).items() for x in kv))
    levels = F.create_map(*(F.lit(x) for kv in LEVEL_NAMES.items() for x in kv))
    return df.withColumns({
        "varname": F.coalesce(cf[F.col("param")], F.col("param")), "typeOfLevel": F.coalesce(levels[F.col("levtype")], F.col("levtype")),
        "level": F.coalesce(F.expr("try_cast(levelist AS DOUBLE)"), F.lit(0.0)), "stepType": F.when(F.col("param").isin(ACCUMULATED), "accum").otherwise("instant"),
        "step_h": F.coalesce(F.expr("try_cast(step AS INT)"), F.lit(0)),
    })


def parse_ref_key(df: DataFrame, key: str = "key") -> DataFrame:
    """step_h, varname, level and member of a key, by the first of the archives' forms that fits.

    `step_SSS/var/level/member/0.0.0`, the same without the step, or `var/level/step/member/0...`; null where none fits.
    """
    k = F.col(key)
    forms = ((r"^step_(\d+)/([^/]+)/([^/]+)/([^/]+)/0[\d.]*$", (1, 2, 3, 4)), (r"^([^/]+)/([^/]+)/(\d+)/([^/]+)/0[\d.]*$", (3, 1, 2, 4)), (r"^([^/]+)/([^/]+)/([^/]+)/0[\d.]*$", (0, 1, 2, 3)))
    part = lambda n: F.coalesce(*(extract(k, p, g[n]) if g[n] else F.lit(None).cast("string") for p, g in forms))
    return df.withColumns({"step_h": part(0).cast("int"), "varname": part(1), "level": part(2), "member": part(3)})


def parse_chunk_key(df: DataFrame, key: str = "key") -> DataFrame:
    """Path and chunk index of `var/stepType/level/var/i.j.k`."""
    return df.withColumns({"path": extract(F.col(key), r"^(.*)/\d+(?:\.\d+)*$"), "chunk": F.transform(F.split(extract(F.col(key), r"/(\d+(?:\.\d+)*)$"), r"\."), lambda x: x.cast("int"))})


def build_ref_key(df: DataFrame, with_level: bool = True) -> DataFrame:
    """`step_SSS/var/level/member/0.0.0`; without the level value, as older stores do, levels of one type collide."""
    level = F.concat_ws("_", "levtype", "levelist") if with_level else F.col("levtype")
    name = F.replace(F.lower("param"), F.lit(" "), F.lit("_"))
    return df.withColumn("key", F.concat_ws("/", F.format_string("step_%03d", "step_h"), name, F.replace(level, F.lit(" "), F.lit("_")), "member", F.lit("0.0.0")))


def build_hier_key(df: DataFrame) -> DataFrame:
    deep = F.col("typeOfLevel").isin("isobaricInhPa", "hybrid", "soil")
    return df.withColumn("key", F.when(deep, F.concat_ws("/", "varname", "typeOfLevel", F.col("level").cast("int").cast("string"), F.col("step_h").cast("string"))).otherwise(F.concat_ws("/", "varname", "typeOfLevel", F.col("step_h").cast("string"))))


def normalize_member(df: DataFrame, column: str = "number") -> DataFrame:
    """member_no (0: control) and member (control, ens01 ...) from a number or a name in any of the archives' forms.

    Null, negative numbers and the control's names are the control; what is no member at all is null.
    """
    c = F.col(column).cast("string")
    digits = F.expr("try_cast(_digits AS INT)")
    control = F.col("_name").isNull() | F.col("_name").rlike("^(?i)(control|cf|oper)?$")
    out = df.withColumns({"_digits": F.regexp_extract(c, r"^(?:ens_?)?(-?\d+)(?:\.0+)?$", 1), "_name": c})
    out = out.withColumn("member_no", F.when(control, 0).otherwise(F.when(digits.isNotNull(), F.greatest(digits, F.lit(0))))).drop("_digits", "_name")
    return out.withColumn("member", F.when(F.col("member_no") == 0, "control").when(F.col("member_no").isNotNull(), F.format_string("ens%02d", "member_no")))


def alias_variable(wanted: DataFrame, stored: DataFrame, aliases: DataFrame) -> DataFrame:
    """For each requested name the stored name of the best priority (1 first); null where none is stored."""
    options = wanted.join(aliases, "requested", "left").join(stored.select(F.col("varname").alias("candidate"), F.lit(True).alias("there")).distinct(), "candidate", "left")
    return options.groupBy("requested").agg(F.min_by(F.when(F.col("there"), F.col("candidate")), F.when(F.col("there"), F.col("priority"))).alias("varname"))


def convert_units(df: DataFrame, units: DataFrame) -> DataFrame:
    """`value * scale + shift` for the variables of a small table (varname, scale, shift)."""
    scale, shift = F.coalesce("scale", F.lit(1.0)), F.coalesce("shift", F.lit(0.0))
    return df.join(units, "varname", "left").withColumn("value", F.col("value") * scale + shift).drop("scale", "shift")


def geopotential(df: DataFrame) -> DataFrame:
    """Geopotential z from geopotential height gh; soil temperatures by level."""
    gh = F.col("varname") == "gh"
    name = F.when(gh, F.concat(F.lit("z_"), F.col("level").cast("int").cast("string"))).when(F.col("varname") == "sot", F.concat(F.lit("stl"), F.col("level").cast("int").cast("string")))
    return df.withColumns({"value": F.when(gh, F.col("value") * GRAVITY).otherwise(F.col("value")), "field": F.coalesce(name, F.col("varname"))})


def level_coord(df: DataFrame, column: str = "coord") -> DataFrame:
    return df.withColumn("dim", F.when(F.col(column).isin(COORDINATES), F.col(column)).otherwise("level"))


def lon_wrap(df: DataFrame, lon: str = "lon", to_360: bool = False) -> DataFrame:
    wrapped = F.pmod(F.col(lon), F.lit(360.0)) if to_360 else F.pmod(F.col(lon) + 180.0, F.lit(360.0)) - 180.0
    return df.withColumn(lon, wrapped)


def chunk_ref_kind(df: DataFrame, value: str = "value") -> DataFrame:
    """base64, ref or unknown; a reference's triple is split."""
    v = F.col(value)
    triple = F.from_json(v, "array<string>")
    ref = v.startswith("[")
    kind = F.when(v.startswith("base64:"), "base64").when(ref & (F.size(triple) == 3), "ref").otherwise("unknown")
    return df.withColumns({"kind": kind, "uri": F.when(ref, F.get(triple, 0)), "offset": F.when(ref, F.get(triple, 1)).cast("long"), "length": F.when(ref, F.get(triple, 2)).cast("long")})


def decode_inline(df: DataFrame, value: str = "value", dtype: str = "<f8") -> DataFrame:
    """Numbers of a `base64:` value."""

    @F.pandas_udf("array<double>")
    def numbers(raw: pd.Series) -> pd.Series:
        from ..operators.store import split_numbers

        return split_numbers(raw, dtype)

    return df.withColumn("values", numbers(F.when(F.col(value).startswith("base64:"), F.unbase64(F.expr(f"substring({value}, 8)")))))


def local_time_window(df: DataFrame, offset_h: int = 3) -> DataFrame:
    """Start and end of the UTC day of `valid_time`, labelled at a local offset."""
    start = F.date_trunc("day", "valid_time").cast("timestamp_ntz") + hours(F.lit(offset_h))
    return df.withColumns({"window_start": F.date_format(start, "yyyy-MM-dd HH:mm"), "window_end": F.date_format(start + hours(F.lit(24)), "yyyy-MM-dd HH:mm")})


def value_codec(df: DataFrame, value: str = "value") -> DataFrame:
    """Wire form of a store's value: JSON as it is, other text as base64, with its type; and back again."""
    is_json = F.col(value).startswith("[") | F.col(value).startswith("{")
    out = df.withColumns({"value_type": F.when(is_json, "json").otherwise("bytes"), "encoded": F.when(is_json, F.col(value)).otherwise(F.base64(F.encode(value, "UTF-8")))})
    return out.withColumn("restored", F.when(F.col("value_type") == "json", F.col("encoded")).otherwise(F.decode(F.unbase64("encoded"), "UTF-8")))
