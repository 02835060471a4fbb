"""Time axes and the four forecast aggregations (horizon, valid time, run time, best available)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.project import hours


def steps_axis(runs: DataFrame, *ranges: tuple[int, int, int], run: str = "run_time") -> DataFrame:
    """run_time, step_h and valid_time of each run, for ranges (first, last, step) in hours."""
    steps = F.concat(*(F.sequence(*map(F.lit, r)) for r in ranges))
    axis = runs.select(run).distinct().withColumn("step_h", F.explode(steps))
    return axis.withColumn("valid_time", F.col(run) + hours(F.col("step_h")))


def axes_gfs(runs: DataFrame) -> DataFrame:
    return steps_axis(runs, (0, 120, 1))


def axes_gefs(runs: DataFrame) -> DataFrame:
    return steps_axis(runs, (0, 240, 3))


def axes_ecmwf(runs: DataFrame) -> DataFrame:
    """85 steps: 3-hourly to 144, then 6-hourly to 360."""
    return steps_axis(runs, (0, 144, 3), (150, 360, 6))


def axes_cfs(runs: DataFrame, max_hours: int = 240) -> DataFrame:
    return steps_axis(runs, (0, max_hours, 6))


def horizon(valid: DataFrame, ranges: DataFrame) -> DataFrame:
    """Grid of step ranges (horizon_pos, steps) and numbered valid times (j, valid_time): range steps repeat along time."""
    grid = valid.crossJoin(ranges).withColumn("step_h", F.get("steps", F.pmod(F.col("j"), F.size("steps"))))
    return grid.withColumn("time", F.col("valid_time") - hours(F.col("step_h"))).drop("steps")


def by_valid_time(valid: DataFrame, steps: DataFrame) -> DataFrame:
    return valid.crossJoin(steps).withColumn("time", F.col("valid_time") - hours(F.col("step_h")))


def by_run_time(runs: DataFrame, steps: DataFrame) -> DataFrame:
    return runs.crossJoin(steps).withColumn("valid_time", F.col("time") + hours(F.col("step_h")))


def best_available(valid: DataFrame, as_of: DataFrame) -> DataFrame:
    """Each valid time from the run at that time, or from the run `as_of` (one row) once it lies ahead."""
    timed = valid.crossJoin(F.broadcast(as_of)).withColumn("time", F.least("valid_time", "as_of"))
    return timed.withColumn("step_h", F.expr("CAST(timestampdiff(HOUR, time, valid_time) AS INT)")).drop("as_of")


def shift_template_dates(template: DataFrame, target: DataFrame) -> DataFrame:
    """Times of a template moved by the days from its reference date to the target date."""
    days = F.make_dt_interval(F.datediff("target_date", "reference_date"))
    return template.crossJoin(F.broadcast(target)).withColumns({"time": F.col("time") + days, "valid_time": F.col("valid_time") + days})
