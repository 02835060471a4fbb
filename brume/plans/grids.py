"""Queries over forecast cells: totals, probabilities, comparisons, axes, features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import project as P
from ..operators import aggregates as A
from ..operators import axes as X
from ..operators import features as M
from ..operators import filters as L
from ..operators import joins as J
from ..operators import sets as S
from ..operators import store as R
from ..schemas import REGIONS, UNITS
from ..sources import stores as O
from . import views as V
from .messages import KINDEX, kindex, sql
from .registry import query

KEYS = "varname, member, cell"
NAMES = ["click", "error", "purchase", "signup", "view"]
FC = """fc AS (SELECT varname, member, cell, CAST(ceil(step_h / 24.0) AS INT) AS day, CAST(sum(CASE WHEN isnan(CAST(value AS DOUBLE)) THEN 0 ELSE CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS value FROM {src} WHERE step_h > 0 GROUP BY ALL HAVING count(*) = 8)"""
PROB = """prob AS (SELECT varname, day, cell, threshold, round(100.0 * count_if(value >= threshold) / count(*), 6) AS probability FROM fc, (SELECT unnest([5.0, 25.0, 50.0, 75.0, 100.0, 125.0]::DOUBLE[]) AS threshold) GROUP BY ALL)"""
STATS = """stats AS (SELECT varname, step_h, cell, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, max(v) AS max, min(v) AS min FROM (SELECT *, CASE WHEN NOT isnan(value) THEN value END AS v FROM nans) GROUP BY ALL)"""
FULL = """full_mean AS (SELECT varname, step_h, cell, round(avg(CAST(value AS DOUBLE)), 6) AS value FROM dense GROUP BY ALL), part_mean AS (SELECT varname, step_h, cell, round(avg(CAST(value AS DOUBLE)), 6) AS value FROM dense WHERE member <> 0 GROUP BY ALL),
both_grids AS (SELECT f.*, f.value AS a, p.value AS b FROM full_mean f JOIN part_mean p USING (varname, step_h, cell))"""


def fc(src):
    return FC.format(src=src)


def totals(spark, d):
    return A.accumulate_24h_fc(V.cells_dense(spark, d))


def two_grids(spark, d):
    c = V.cells_dense(spark, d).withColumn("value", F.col("value").cast("double"))
    mean = lambda x: x.groupBy("varname", "step_h", "cell").agg(F.round(F.avg("value"), 6).alias("value"))
    return J.align_grids(mean(c), mean(c.where("member <> 0")))


def as_double(df, column="value"):
    return df.withColumn(column, F.col(column).cast("double"))


@query(sql("SELECT varname, day, cell, threshold, probability FROM prob", "dense", also=fc("dense") + ",\n" + PROB))
def exceedance_prob(spark, d):
    return A.exceedance_prob(totals(spark, d))


@query(sql("SELECT varname, day, cell, threshold, round(100.0 * count_if(value >= threshold) / any_value(alive), 6) AS probability FROM fc JOIN (SELECT varname, count(DISTINCT member) AS alive FROM fc GROUP BY 1) USING (varname), (SELECT unnest([5.0, 25.0, 50.0, 75.0, 100.0, 125.0]::DOUBLE[]) AS threshold) GROUP BY ALL", "nans", also=fc("nans")))
def exceedance_prob_valid(spark, d):
    return A.exceedance_prob_valid(A.accumulate_24h_fc(V.cells_nan(spark, d)))


@query(sql("SELECT varname, step_h, cell, threshold, round(100.0 * count_if(NOT isnan(value) AND value >= threshold) / count(*), 6) AS probability FROM nans, (SELECT unnest([5.0, 25.0, 50.0, 75.0, 100.0, 125.0]::DOUBLE[]) AS threshold) WHERE step_h = 240 GROUP BY ALL", "nans"))
def step_exceedance(spark, d):
    return A.step_exceedance(V.cells_nan(spark, d), 240)


@query(sql("SELECT varname, member, cell, CAST(step_h // 24 AS INT) AS day, CAST(sum(value) AS DOUBLE) AS total FROM dense GROUP BY ALL HAVING count(*) = 8", "dense"))
def accumulate_24h(spark, d):
    return as_double(A.accumulate_24h(V.cells_dense(spark, d)), "total")


@query(sql("SELECT varname, member, cell, day, value FROM fc", "nans", also=fc("nans")))
def accumulate_24h_fc(spark, d):
    return A.accumulate_24h_fc(V.cells_nan(spark, d))


@query(sql("SELECT varname, day, threshold, max(probability) AS max_probability, count_if(probability >= 50) AS cells_50 FROM prob GROUP BY ALL", "dense", also=fc("dense") + ",\n" + PROB))
def prob_summary(spark, d):
    return A.prob_summary(A.exceedance_prob(totals(spark, d)))


@query(sql("SELECT * FROM stats", "nans", also=STATS))
def ensemble_stats(spark, d):
    return A.ensemble_stats(V.cells_nan(spark, d))


@query(sql("SELECT *, round(2 * std, 5) AS approx_range, round(max - min, 6) AS spread FROM stats", "nans", also=STATS))
def spread_range(spark, d):
    return A.spread_range(A.ensemble_stats(V.cells_nan(spark, d)))


@query(sql("SELECT varname, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, round(quantile_cont(v, 0.9), 6) AS p90, round(quantile_cont(v, 0.95), 6) AS p95, round(quantile_cont(v, 0.99), 6) AS p99 FROM (SELECT varname, CASE WHEN NOT isnan(value) THEN value END AS v FROM nans) GROUP BY varname", "nans"))
def percentile_thresholds(spark, d):
    return A.percentile_thresholds(V.cells_nan(spark, d))


@query(sql("SELECT round(avg(a - b), 6) AS mean_diff, round(stddev_pop(a - b), 6) AS std_diff, round(max(abs(a - b)), 6) AS max_abs, round(min(abs(a - b)), 6) AS min_abs, round(sqrt(avg((a - b) * (a - b))), 6) AS rmse, round(max(abs(a - b) / (abs(a) + 1e-10)), 6) AS max_rel, round(avg(abs(a - b) / (abs(a) + 1e-10)), 6) AS mean_rel, round(max(abs(a - b) / (abs(a) + 1e-10)), 6) < 1e-4 AS match FROM both_grids WHERE a > 0", "dense", also=FULL))
def compare_stats(spark, d):
    return A.compare_stats(two_grids(spark, d).where("a > 0"))


@query(sql("SELECT step_h, CASE WHEN stddev_pop(a) > 0 AND stddev_pop(b) > 0 THEN round(corr(a, b), 6) END AS r, round(sqrt(avg((a - b) * (a - b))), 6) AS rmse, round(avg(abs(a - b)), 6) AS mae, round(max(abs(a - b)), 6) AS max_abs, round(avg(abs(a - b)) / greatest(avg(abs(b)), 1e-12) * 100, 6) AS rel_percent, count(*) AS n FROM both_grids GROUP BY ROLLUP (step_h)", "dense", also=FULL))
def skill_stats(spark, d):
    return A.skill_stats(two_grids(spark, d))


@query(sql("SELECT varname, step_h, count(*) AS total, count_if(isnan(value)) AS n_nan, count(v) AS n_finite, min(v) AS low, max(v) AS high, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, CASE WHEN max(v) < 1 THEN 'm' ELSE 'mm' END AS unit_guess FROM (SELECT *, CASE WHEN NOT isnan(value) THEN value END AS v FROM nans) GROUP BY GROUPING SETS ((varname, step_h), (varname))", "nans"))
def nan_diagnostics(spark, d):
    return A.nan_diagnostics(V.cells_nan(spark, d))


@query(sql("SELECT varname, member, cell, CAST(step_h // 24 AS INT) AS day, CAST(min(value) AS DOUBLE) AS tmin, CAST(max(value) AS DOUBLE) AS tmax FROM dense WHERE step_h % 6 = 0 GROUP BY ALL", "dense"))
def daily_min_max(spark, d):
    return as_double(as_double(A.daily_min_max(V.cells_dense(spark, d)), "tmin"), "tmax")


@query(sql("SELECT varname, member, cell, step_h, CAST(value AS DOUBLE) * CASE varname WHEN 'purchase' THEN 1000 ELSE 1 END - CASE varname WHEN 'click' THEN 273.15 ELSE 0 END AS value FROM cells", "cells"))
def convert_units(spark, d):
    scale, shift = UNITS["tp"][0], UNITS["t2m"][1]
    units = V.cells(spark, d).select("varname").distinct().withColumns({"scale": F.when(F.col("varname") == "purchase", scale).otherwise(1.0), "shift": F.when(F.col("varname") == "click", shift).otherwise(0.0)})
    return P.convert_units(as_double(V.cells(spark, d)), units).select("varname", "member", "cell", "step_h", "value")


@query(sql("SELECT member, cell, step_h, varname, CASE WHEN varname = 'view' THEN 'z_' || cell WHEN varname = 'click' THEN 'stl' || cell ELSE varname END AS field, CASE WHEN varname = 'view' THEN CAST(value AS DOUBLE) * 9.80665 ELSE CAST(value AS DOUBLE) END AS value FROM cells", "cells"))
def geopotential(spark, d):
    c = as_double(V.cells(spark, d)).withColumns({"own": F.col("varname"), "level": F.col("cell"), "varname": F.when(F.col("varname") == "view", "gh").when(F.col("varname") == "click", "sot").otherwise(F.col("varname"))})
    return P.geopotential(c).select("member", "cell", "step_h", F.col("own").alias("varname"), "field", "value")


@query(sql("SELECT DISTINCT cell, round(((lon * 12 + 180) - 360 * floor((lon * 12 + 180) / 360)) - 180, 6) AS lon FROM cells", "cells"))
def lon_wrap(spark, d):
    c = V.cells(spark, d).select("cell", (F.col("lon") * 12).alias("lon")).distinct()
    return P.lon_wrap(c).withColumn("lon", F.round("lon", 6))


@query(sql("SELECT varname, member, step_h, cell FROM cells WHERE lat BETWEEN -12 AND 15 AND lon BETWEEN 21 AND 40", "cells"))
def crop_region(spark, d):
    assert "east_africa" in REGIONS
    return L.crop_region(V.cells(spark, d), (-12.0, 15.0, 21.0, 40.0)).select("varname", "member", "step_h", "cell")


@query(sql("SELECT CAST(t AS DOUBLE) / 10 AS target_h, (SELECT min_by(step_h, (abs(step_h - t / 10.0), step_h)) FROM (SELECT DISTINCT step_h FROM cells) WHERE abs(step_h - t / 10.0) < 0.5) AS step_h FROM (SELECT DISTINCT step_h * 10 + cell AS t FROM cells)", "cells"))
def select_steps(spark, d):
    c = V.cells(spark, d)
    return L.select_steps(c, c.select(((F.col("step_h") * 10 + F.col("cell")) / 10.0).alias("target_h")).distinct())


@query(sql("SELECT varname, member, step_h, cell, CASE WHEN isnan(value) OR value < 0 THEN 0 ELSE value END AS value FROM nans", "nans"))
def valid_numeric(spark, d):
    return L.valid_numeric(V.cells_nan(spark, d)).select("varname", "member", "step_h", "cell", "value")


@query(sql("SELECT varname, member, cell, step_h, CAST(greatest(value - start, 0) AS DOUBLE) AS total FROM (SELECT *, max(value) OVER (PARTITION BY varname, member, cell ORDER BY step_h RANGE BETWEEN 24 PRECEDING AND 24 PRECEDING) AS start FROM cum) WHERE start IS NOT NULL", "cum"))
def diff_24h(spark, d):
    return as_double(J.diff_24h(V.cells_cumulative(spark, d)), "total")


@query(sql("SELECT varname, member, cell, step_h, CAST(CASE WHEN step_h <= 48 THEN value WHEN start IS NOT NULL THEN greatest(value - start, 0) END AS DOUBLE) AS total FROM (SELECT *, max(value) OVER (PARTITION BY varname, member, cell ORDER BY step_h RANGE BETWEEN 48 PRECEDING AND 48 PRECEDING) AS start FROM cum)", "cum"))
def precip_window(spark, d):
    return as_double(J.precip_window(V.cells_cumulative(spark, d), 48), "total")


@query(sql("SELECT varname, step_h, cell, a, b FROM both_grids", "dense", also=FULL))
def align_grids(spark, d):
    return two_grids(spark, d)


@query(sql("SELECT count_if(a IS NULL) AS only_b, count_if(b IS NULL) AS only_a, count(*) AS cells FROM (SELECT f.value AS a, p.value AS b FROM (SELECT * FROM full_mean WHERE step_h < 300) f FULL JOIN (SELECT * FROM part_mean WHERE step_h >= 150) p USING (varname, step_h, cell))", "dense", also=FULL))
def grid_mismatch(spark, d):
    c = V.cells_dense(spark, d)
    mean = lambda x: x.groupBy("varname", "step_h", "cell").agg(F.avg("value").alias("value"))
    return J.grid_mismatch(J.align_grids(mean(c.where("step_h < 300")), mean(c.where("member <> 0 AND step_h >= 150"))))


STEPS = """ks AS (SELECT step_h, count(DISTINCT varname) AS k FROM cells GROUP BY 1), nv AS (SELECT count(DISTINCT varname) AS n FROM cells),
ax AS (SELECT step_h FROM ks, nv WHERE k = n OR NOT EXISTS (SELECT 1 FROM ks, nv WHERE k = n))"""


@query(sql("SELECT v.varname, ax.step_h, (SELECT CAST(sum(value) AS DOUBLE) FROM cells c WHERE c.varname = v.varname AND c.step_h = ax.step_h) AS value FROM ax, (SELECT DISTINCT varname FROM cells) v", "cells", also=STEPS))
def align_steps(spark, d):
    return as_double(J.align_steps(V.cells(spark, d)))


@query(sql("SELECT h1, h2, (SELECT min_by(step_h, (abs(step_h - h1), step_h)) FROM ss) AS step_1, (SELECT min_by(step_h, (abs(step_h - h2), step_h)) FROM ss) AS step_2 FROM (SELECT DISTINCT cell * 7 AS h1, cell * 7 + 5 AS h2 FROM cells)", "cells", also="ss AS (SELECT DISTINCT step_h FROM cells)"))
def nearest_step_pair(spark, d):
    c = V.cells(spark, d)
    return J.nearest_step_pair(c, c.select((F.col("cell") * 7).alias("h1"), (F.col("cell") * 7 + 5).alias("h2")).distinct())


@query(sql("SELECT varname, count(DISTINCT member) AS k FROM cells GROUP BY 1 HAVING count(DISTINCT member) = (SELECT count(DISTINCT member) FROM cells)", "cells"))
def common_variables(spark, d):
    return S.common_variables(V.cells(spark, d))


@query(sql("SELECT member, varname, step_h, cell, CAST(value AS DOUBLE) AS value, CASE WHEN member = 1 THEN lat END AS lat FROM cells", "cells"))
def concat_members(spark, d):
    c = as_double(V.cells(spark, d))
    parts = {m: c.where(F.col("member") == m).select("varname", "step_h", "cell", "value", *(["lat"] if m == 1 else [])) for m in range(5)}
    return S.concat_members(parts)


@query(sql("SELECT varname, member, step_h, cell FROM dense", "dense"))
def combine_hours(spark, d):
    c = V.cells_dense(spark, d)
    return S.combine_hours([c.where("step_h <= 24"), c.where("step_h > 24 AND step_h <= 48"), c.where("step_h > 48")]).select("varname", "member", "step_h", "cell")


@query(sql("SELECT varname, member, step_h, cell FROM cells WHERE step_h NOT IN (SELECT step_h FROM cells WHERE step_h % 2 = 0)", "cells"))
def append_new_times(spark, d):
    c = V.cells(spark, d)
    return O.new_times(c, c.where("step_h % 2 = 0"), "step_h").select("varname", "member", "step_h", "cell")


@query(sql("SELECT step_h, TIMESTAMP '2024-01-01' + to_hours(step_h) AS valid_time, cell, " + ", ".join(f"round(CAST(CAST(avg(v) FILTER (varname = '{n}') AS FLOAT) AS DOUBLE), 3) AS {n}_ensemble_mean, round(CAST(CAST(stddev_pop(v) FILTER (varname = '{n}') AS FLOAT) AS DOUBLE), 3) AS {n}_ensemble_standard_deviation" for n in NAMES) + " FROM (SELECT *, CASE WHEN NOT isnan(value) THEN value END AS v FROM nans) GROUP BY ALL", "nans"))
def write_feature_cube(spark, d):
    """The cube of all variables, written and read back; float32 values are compared at three places."""
    from ..sources.scratch import shared_table

    timed = V.cells_nan(spark, d).withColumn("valid_time", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("step_h")))
    cube = shared_table(O.feature_cube(timed, NAMES), "cube")
    assert all(t == "float" for c, t in cube.dtypes if "ensemble" in c)
    return cube.select("step_h", "valid_time", "cell", *(F.round(F.col(c).cast("double"), 3).alias(c) for c in cube.columns if "ensemble" in c))


RUNS = "runs AS (SELECT DISTINCT CAST(o_orderdate AS TIMESTAMP) AS run_time FROM orders)"


def runs(spark, d):
    return V.table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp_ntz").alias("run_time")).distinct()


def axis_sql(steps):
    return f"WITH {RUNS} SELECT run_time, CAST(s AS INT) AS step_h, run_time + to_hours(CAST(s AS INT)) AS valid_time FROM runs, unnest({steps}) AS u(s)"


@query(axis_sql("range(0, 121)"))
def axes_gfs(spark, d):
    return X.axes_gfs(runs(spark, d))


@query(axis_sql("range(0, 241, 3)"))
def axes_gefs(spark, d):
    return X.axes_gefs(runs(spark, d))


@query(axis_sql("list_concat(range(0, 145, 3), range(150, 361, 6))"))
def axes_ecmwf(spark, d):
    return X.axes_ecmwf(runs(spark, d))


@query(axis_sql("range(0, 241, 6)"))
def axes_cfs(spark, d):
    return X.axes_cfs(runs(spark, d))


VALID = "valid AS (SELECT valid_time, CAST(row_number() OVER (ORDER BY valid_time) - 1 AS INT) AS j FROM (SELECT DISTINCT \"time\" AS valid_time FROM kindex))"


def valid_times(spark, d):
    """Run times in order, numbered: one row of all of them, as they are the axis of an array."""
    times = kindex(spark, d).agg(F.sort_array(F.collect_set("time")).alias("t"))
    return times.select(F.posexplode("t").alias("j", "valid_time"))


@query(sql("SELECT pos AS horizon_pos, j, valid_time, CAST(steps[j % len(steps) + 1] AS INT) AS step_h, valid_time - to_hours(CAST(steps[j % len(steps) + 1] AS INT)) AS \"time\" FROM valid, (SELECT 0 AS pos, [0, 3, 6, 9] AS steps UNION ALL SELECT 1, [12, 15])", "msg", "mapping", also=f"{KINDEX},\n{VALID}"))
def fmrc_horizon(spark, d):
    ranges = spark.range(1).select(F.explode(F.array(F.struct(F.lit(0).alias("horizon_pos"), F.array(*map(F.lit, (0, 3, 6, 9))).alias("steps")), F.struct(F.lit(1).alias("horizon_pos"), F.array(F.lit(12), F.lit(15)).alias("steps")))).alias("r")).select("r.*")
    return X.horizon(valid_times(spark, d), ranges).select("horizon_pos", "j", "valid_time", "step_h", "time")


@query(sql("SELECT valid_time, step_h, valid_time - to_hours(step_h) AS \"time\" FROM valid, (SELECT DISTINCT step_h FROM kindex)", "msg", "mapping", also=f"{KINDEX},\n{VALID}"))
def fmrc_valid_time(spark, d):
    k = kindex(spark, d)
    return X.by_valid_time(k.select(F.col("time").alias("valid_time")).distinct(), k.select("step_h").distinct())


@query(sql("SELECT \"time\", step_h, \"time\" + to_hours(step_h) AS valid_time FROM (SELECT DISTINCT \"time\" FROM kindex), (SELECT DISTINCT step_h FROM kindex)", "msg", "mapping", also=KINDEX))
def fmrc_run_time(spark, d):
    k = kindex(spark, d)
    return X.by_run_time(k.select("time").distinct(), k.select("step_h").distinct())


BEST = """grid AS (SELECT valid_time, least(valid_time, r) AS "time", CAST(date_diff('hour', least(valid_time, r), valid_time) AS INT) AS step_h FROM (SELECT DISTINCT valid_time FROM kindex), (SELECT quantile_disc("time", 0.5) AS r FROM (SELECT DISTINCT "time" FROM kindex)))"""


def best_grid(spark, d):
    k = kindex(spark, d)
    days = k.select("time").distinct()
    half = days.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY datediff(time, DATE '1970-01-01'))").cast("int").alias("n")).select((F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.col("n"))).alias("as_of"))
    return X.best_available(k.select("valid_time").distinct(), half)


@query(sql("SELECT valid_time, \"time\", step_h FROM grid", "msg", "mapping", also=f"{KINDEX},\n{BEST}"))
def fmrc_best_available(spark, d):
    return best_grid(spark, d)


STORE = """t AS (SELECT DISTINCT "time" FROM kindex), s AS (SELECT DISTINCT step_h FROM kindex), v AS (SELECT DISTINCT valid_time FROM kindex),
tn AS (SELECT "time", row_number() OVER (ORDER BY "time") - 1 AS i FROM t), sn AS (SELECT step_h, row_number() OVER (ORDER BY step_h) - 1 AS i FROM s), vn AS (SELECT valid_time, row_number() OVER (ORDER BY valid_time) - 1 AS i FROM v),
axes AS (SELECT 'horizon' AS axis, valid_time - to_hours(h) AS "time", h AS step_h, valid_time, [pos, j] AS place FROM (SELECT pos, j, valid_time, CAST(steps[j % len(steps) + 1] AS INT) AS h FROM (SELECT valid_time, i AS j FROM vn), (SELECT 0 AS pos, [0, 3, 6, 9] AS steps UNION ALL SELECT 1, [12, 15]))
  UNION ALL SELECT 'valid_time', valid_time - to_hours(step_h), step_h, valid_time, [vn.i, sn.i] FROM vn, sn
  UNION ALL SELECT 'run_time', "time", step_h, "time" + to_hours(step_h), [tn.i, sn.i] FROM tn, sn
  UNION ALL SELECT 'best_available', "time", step_h, valid_time, [i] FROM grid JOIN vn USING (valid_time)),
pathed AS (SELECT *, varname || '/' || "stepType" || '/' || "typeOfLevel" AS path FROM kindex),
placed AS (SELECT *, dense_rank() OVER (PARTITION BY path ORDER BY level) - 1 AS k FROM pathed),
groups AS (SELECT path, varname, "typeOfLevel", count(DISTINCT level) AS n FROM pathed GROUP BY ALL),
nt AS (SELECT count(*) AS n FROM t), ns AS (SELECT count(*) AS n FROM s), nv AS (SELECT count(*) AS n FROM v),
shapes AS (SELECT 'horizon' AS axis, '2,' || n AS shape, '1,1' AS ones, '"model_horizons","valid_times"' AS dims FROM nv UNION ALL SELECT 'valid_time', nv.n || ',' || ns.n, '1,1', '"valid_times","model_horizons"' FROM nv, ns
  UNION ALL SELECT 'run_time', nt.n || ',' || ns.n, '1,1', '"run_times","model_horizons"' FROM nt, ns UNION ALL SELECT 'best_available', n || '', '1', '"valid_times"' FROM nv),
kinds AS (SELECT axis, unnest(['time', 'valid_time', 'step']) AS name, shape, dims FROM shapes),
told AS (SELECT axis, name, CASE WHEN one THEN (SELECT CASE name WHEN 'time' THEN nt.n WHEN 'step' THEN ns.n ELSE nv.n END || '' FROM nt, ns, nv) ELSE shape END AS shape,
  CASE WHEN one THEN CASE name WHEN 'time' THEN '"run_times"' WHEN 'step' THEN '"model_horizons"' ELSE '"valid_times"' END ELSE dims END AS dims,
  CASE WHEN one OR axis = 'best_available' THEN '0' ELSE '0.0' END AS number FROM (SELECT *, axis <> 'horizon' AND ((name = 'step' AND axis <> 'best_available') OR (name = 'valid_time' AND axis <> 'run_time') OR (name = 'time' AND axis = 'run_time')) AS one FROM kinds)),
long AS (SELECT axis, place, unnest([{'name': 'time', 'v': epoch("time")}, {'name': 'valid_time', 'v': epoch(valid_time)}, {'name': 'step', 'v': CAST(step_h AS DOUBLE)}]) AS c FROM axes),
wanted AS (SELECT axis, c.name AS name, place, c.v AS v FROM long WHERE CASE WHEN axis = 'valid_time' AND c.name = 'step' THEN place[1] = 0 WHEN axis = 'valid_time' AND c.name = 'valid_time' THEN place[2] = 0
  WHEN axis = 'run_time' AND c.name = 'step' THEN place[1] = 0 WHEN axis = 'run_time' AND c.name = 'time' THEN place[2] = 0 ELSE true END),
hexed AS (SELECT axis, name, place, hex(CAST(CAST(CAST(v AS DOUBLE) AS BIT) AS BLOB)) AS h FROM wanted),
packed AS (SELECT axis, name, 'base64:' || base64(unhex(string_agg(h[15:16] || h[13:14] || h[11:12] || h[9:10] || h[7:8] || h[5:6] || h[3:4] || h[1:2], '' ORDER BY place))) AS inline FROM hexed GROUP BY ALL),
lhex AS (SELECT path, level, hex(CAST(CAST(level AS BIT) AS BLOB)) AS h FROM (SELECT DISTINCT path, CAST(level AS DOUBLE) AS level FROM pathed)),
lpacked AS (SELECT path, 'base64:' || base64(unhex(string_agg(h[15:16] || h[13:14] || h[11:12] || h[9:10] || h[7:8] || h[5:6] || h[3:4] || h[1:2], '' ORDER BY level))) AS inline FROM lhex GROUP BY ALL)"""


def all_axes(spark, index):
    """Cells of the four axes of a chunk index, numbered by their dims; horizons are the steps 0 to 9 and 12 to 15 in turn."""
    place = lambda *columns: F.array(*(F.col(c).cast("bigint") for c in columns))
    own = index.agg(*(F.sort_array(F.collect_set(c)).alias(n) for c, n in (("time", "times"), ("valid_time", "valids"), ("step_h", "steps"))))  # one row: the axes
    numbered = lambda column, name, i: own.select(F.posexplode(column).alias(i, name))
    times, valids, steps = numbered("times", "time", "t"), numbered("valids", "valid_time", "j"), numbered("steps", "step_h", "s")
    ranges = spark.range(1).select(F.explode(F.array(F.struct(F.lit(0).alias("horizon_pos"), F.array(*map(F.lit, (0, 3, 6, 9))).alias("steps")), F.struct(F.lit(1).alias("horizon_pos"), F.array(F.lit(12), F.lit(15)).alias("steps")))).alias("r")).select("r.*")
    as_of = own.select(F.get("times", F.floor((F.size("times") - 1) / 2).cast("int")).alias("as_of"))
    found = {
        "horizon": (X.horizon(valids, ranges), place("horizon_pos", "j")), "valid_time": (X.by_valid_time(valids, steps), place("j", "s")),
        "run_time": (X.by_run_time(times, steps), place("t", "s")), "best_available": (X.best_available(valids, as_of), place("j")),
    }
    parts = [df.select(F.lit(axis).alias("axis"), "time", F.col("step_h").cast("int").alias("step_h"), "valid_time", p.alias("place")) for axis, (df, p) in found.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(sql("""SELECT axis, path || '/' || varname || '/' || array_to_string(place, '.') || CASE WHEN n > 1 THEN '.' || k ELSE '' END || '.0.0' AS key, 'chunk' AS kind, min_by(uri, (uri, "offset")) AS uri, min_by("offset", (uri, "offset")) AS "offset", min_by(length, (uri, "offset")) AS length, NULL AS meta, NULL AS inline
  FROM axes a JOIN placed p ON a."time" = p."time" AND a.step_h = p.step_h JOIN groups g USING (path, varname) GROUP BY axis, path, varname, place, n, k
UNION ALL SELECT axis, path || '/' || varname || '/.zarray', 'array', NULL, NULL, NULL, '{"shape":[' || shape || CASE WHEN n > 1 THEN ',' || n ELSE '' END || ',721,1440],"chunks":[' || ones || CASE WHEN n > 1 THEN ',1' ELSE '' END || ',721,1440],"dims":[' || dims || CASE WHEN n > 1 THEN ',"' || "typeOfLevel" || '"' ELSE '' END || ',"latitude","longitude"]}', NULL FROM groups, shapes
UNION ALL SELECT axis, path || '/' || name || '/' || number, 'coord', NULL, NULL, NULL, '{"shape":[' || shape || '],"chunks":[' || shape || '],"dims":[' || dims || ']}', inline FROM groups, told JOIN packed USING (axis, name)
UNION ALL SELECT axis, path || '/' || "typeOfLevel" || CASE WHEN n > 1 THEN '/0' ELSE '' END, 'coord', NULL, NULL, NULL, CASE WHEN n > 1 THEN '{"shape":[' || n || '],"chunks":[' || n || '],"dims":["' || "typeOfLevel" || '"]}' ELSE '{"shape":[],"chunks":[],"dims":[]}' END, inline FROM groups JOIN lpacked USING (path), shapes""", "msg", "mapping", also=f"{KINDEX},\n{BEST},\n{STORE}"))
def reinflate(spark, d):
    """The whole stores of all four axes: chunks, arrays and coordinates with their bytes. The index is worked out once and written, as are the axes and the few rows of metadata."""
    from ..sources.scratch import shared_table

    index = shared_table(R.place_levels(shared_table(kindex(spark, d), "chunks")), "index")
    axes = shared_table(all_axes(spark, index), "axes")
    return R.store_chunks(axes, index).unionByName(shared_table(R.store_metadata(axes, index), "metadata"))


@query(sql("SELECT file, idx, \"time\" + INTERVAL 30 DAY AS \"time\", valid_time + INTERVAL 30 DAY AS valid_time FROM kindex", "msg", "mapping", also=KINDEX))
def shift_template_dates(spark, d):
    k = kindex(spark, d)
    target = k.agg(F.min("time").cast("date").alias("reference_date")).withColumn("target_date", F.date_add("reference_date", 30))
    return X.shift_template_dates(k, target).select("file", "idx", "time", "valid_time")


@query("SELECT vec_id, CAST(i - 1 AS INT) AS pos, CAST(embedding[i] AS DOUBLE) AS value, 90.0 - 0.25 * ((i - 1) // 8) AS lat, -180.0 + 0.25 * ((i - 1) % 8) AS lon FROM embeddings, unnest(range(1, 65)) AS u(i)")
def cells_from_grid(spark, d):
    e = V.table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("values"))
    return R.cells_from_grid(e, width=8)


@query("""WITH sizes AS (SELECT label, 8 * (max(vec_id) // 7 + 1) - 3 AS rows FROM embeddings GROUP BY label), cut AS (SELECT label, 8 * (vec_id // 7) + (p - 1) // 8 AS i, 8 * (vec_id % 7) + (p - 1) % 8 AS j, CAST(embedding[p] AS DOUBLE) AS value FROM embeddings, unnest(range(1, 65)) AS u(p))
SELECT label AS "array", CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, CAST(51 * i + j AS BIGINT) AS place, value FROM cut JOIN sizes USING (label) WHERE i < rows AND j < 51""")
def assemble_grid(spark, d):
    """Embeddings as chunks of 8 by 8 of one matrix for each label, 51 wide: chunks hang over its lower and right edge."""
    e = V.table(spark, d, "embeddings").select(F.col("label").alias("array"), "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("values"))
    row, column = F.floor(F.col("vec_id") / 7), F.col("vec_id") % 7
    arrays = e.groupBy("array").agg(F.array(8 * (F.max(row) + 1) - 3, F.lit(51).cast("bigint")).alias("shape")).withColumn("chunks", F.array(F.lit(8), F.lit(8)))
    out = R.assemble_grid(e.select("array", F.array(row, column).alias("chunk"), "values"), arrays)
    return out.select("array", F.get("at", 0).alias("i"), F.get("at", 1).alias("j"), "place", "value")


@query("SELECT vec_id, CAST(i - 1 AS INT) AS pos, CAST(embedding[i] AS DOUBLE) AS value, 'doubles' AS status FROM embeddings, unnest(range(1, 65)) AS u(i)")
def decoder(spark, d):
    """All values packed as bytes, read back by the first decoder that can."""
    import numpy as np

    e = V.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))

    def whole(raw):
        if len(raw) != 3:
            raise ValueError("not three bytes")
        return list(raw)

    out = R.decode_chunks(e.select("vec_id", R.packed_values("v").alias("data")), {"whole": whole, "doubles": lambda raw: np.frombuffer(raw, "<f8")})
    return out.select("vec_id", F.posexplode("values").alias("pos", "value"), "status")


@query("SELECT label, CASE vec_id % 3 WHEN 0 THEN 'tagged' WHEN 1 THEN 'plain' ELSE 'failed' END AS status, count(*) AS n_chunks, CAST(sum(CASE WHEN vec_id % 3 < 2 THEN 64 ELSE 0 END) AS BIGINT) AS n_values FROM embeddings GROUP BY ALL")
def decoder_counts(spark, d):
    """Chunks in three forms: one for the first decoder, one for its fallback, one that none can read."""
    import numpy as np

    def tagged(raw):
        return [np.frombuffer(x, "<f8", offset=1) if len(x) % 8 == 1 and x[:1] == b"D" else None for x in raw]

    def plain(raw):
        return [np.frombuffer(x, "<f8") if x and len(x) % 8 == 0 else None for x in raw]

    e = V.table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    form = F.col("vec_id") % 3
    data = F.when(form == 0, F.concat(F.lit(bytearray(b"D")), "b")).when(form == 1, F.col("b")).otherwise(F.lit(bytearray(b"no numbers")))
    read = R.decode_batches(e.withColumn("b", R.packed_values("v")).select("label", data.alias("data")), {"tagged": tagged, "plain": plain})
    return R.decoder_counts(read, ("label",))


@query("SELECT vec_id, CAST(i - 1 AS INT) AS pos, CAST(embedding[i] AS DOUBLE) AS value FROM embeddings, unnest(range(1, 65)) AS u(i)")
def bytes_to_array(spark, d):
    e = V.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return R.bytes_to_array(e.select("vec_id", R.packed_values("v").alias("data")), dtype="<f8").select("vec_id", F.posexplode("values").alias("pos", "value"))


@query(sql("SELECT step_h, member, cell, " + ", ".join(f"CAST(max(value) FILTER (varname = '{n}') AS DOUBLE) AS {n}" for n in NAMES) + " FROM dense GROUP BY ALL", "dense"))
def flatten_tree(spark, d):
    return R.flatten_tree(as_double(V.cells_dense(spark, d)), NAMES)


NORM = """ns AS (SELECT varname, round(avg(v), 6) AS f_mean, round(stddev_pop(v), 6) AS f_std, min(v) AS f_min, max(v) AS f_max FROM (SELECT varname, CASE WHEN NOT isnan(value) THEN value END AS v FROM nans) GROUP BY 1)"""
KINDS = {"purchase": "log", "click": "standard", "view": "max"}


@query(sql("SELECT * FROM ns", "nans", also=NORM))
def norm_stats(spark, d):
    return M.norm_stats(V.cells_nan(spark, d))


@query(sql("SELECT varname, member, step_h, cell, round(CASE varname WHEN 'purchase' THEN log10(1 + greatest(v, 0)) WHEN 'click' THEN (v - f_mean) / f_std WHEN 'view' THEN v / f_max ELSE v END, 6) AS value FROM (SELECT *, CAST(value AS DOUBLE) AS v FROM dense) JOIN ns USING (varname)", "nans", also=NORM))
def normalize_field(spark, d):
    return M.normalize_field(V.cells_dense(spark, d), M.norm_stats(V.cells_nan(spark, d)), KINDS).select("varname", "member", "step_h", "cell", "value")


CHANNELS = """hs AS (SELECT DISTINCT step_h AS step_1, step_h + 3 AS step_2 FROM cells), ch AS (SELECT a.varname, a.cell, step_1, step_2, a.mean AS mean_1, a.std AS std_1, b.mean AS mean_2, b.std AS std_2 FROM hs JOIN stats a ON a.step_h = step_1 JOIN stats b ON b.step_h = step_2 AND b.varname = a.varname AND b.cell = a.cell)"""


NCH = """nm AS (SELECT varname, round(avg(mean), 6) AS f_mean, round(stddev_pop(mean), 6) AS f_std, max(mean) AS f_max FROM stats GROUP BY 1),
nch AS (SELECT varname, cell, step_1, step_2, """ + ", ".join(f"round(CASE varname WHEN 'purchase' THEN log10(1 + greatest({c}, 0)) WHEN 'click' THEN ({c} - f_mean) / f_std WHEN 'view' THEN {c} / f_max ELSE {c} END, 6) AS {c}" for c in ("mean_1", "std_1", "mean_2", "std_2")) + " FROM ch JOIN nm USING (varname))"


def channels(spark, d):
    c = V.cells_nan(spark, d)
    stats = A.ensemble_stats(c)
    known = M.norm_stats(stats.select("varname", F.col("mean").alias("value")))
    return M.four_channel(M.normalize_field(stats, known, KINDS, ("mean", "std")), V.cells(spark, d).select(F.col("step_h").alias("step_1"), (F.col("step_h") + 3).alias("step_2")).distinct())


@query(sql("SELECT * FROM nch", "nans", also=f"{STATS},\n{CHANNELS},\n{NCH}"))
def four_channel(spark, d):
    return channels(spark, d)


@query(sql("SELECT step_1, step_2, cell, CAST(4 * count(*) AS INT) AS n, max(mean_1) FILTER (varname = 'click') AS first, max(std_2) FILTER (varname = 'view') AS last FROM nch GROUP BY ALL", "nans", also=f"{STATS},\n{CHANNELS},\n{NCH}"))
def feature_tensor(spark, d):
    t = M.feature_tensor(channels(spark, d), ["click", "absent", "error", "purchase", "signup", "view"])
    return t.select("step_1", "step_2", "cell", F.size("features").alias("n"), F.get("features", 0).alias("first"), F.element_at("features", -1).alias("last"))


@query(sql("SELECT varname, member AS ensemble, CAST(dense_rank() OVER (PARTITION BY varname ORDER BY step_h) - 1 AS INT) AS time_index, cell, CAST(value AS DOUBLE) AS value FROM cells", "cells"))
def restructure(spark, d):
    return as_double(M.restructure(V.cells(spark, d)))


@query(sql("SELECT step_h, member, CAST(count(DISTINCT varname) AS INT) AS n_fields, CAST(max(value) FILTER (varname = 'click' AND cell = 0) AS DOUBLE) AS first FROM dense GROUP BY ALL", "dense"))
def input_state(spark, d):
    s = M.input_state(as_double(V.cells_dense(spark, d)))
    return s.select("step_h", "member", F.size("fields").alias("n_fields"), F.get(F.element_at("fields", "click"), 0).alias("first"))


@query(sql("SELECT s.step_h, member, cell, CAST(value AS DOUBLE) AS value, c.varname IS NULL AS missing FROM (SELECT DISTINCT step_h * 2 AS step_h FROM cells) s LEFT JOIN (SELECT * FROM cells WHERE varname = 'purchase') c USING (step_h)", "cells"))
def extract_all_steps(spark, d):
    steps = V.cells(spark, d).select((F.col("step_h") * 2).alias("step_h")).distinct()
    return as_double(M.extract_all_steps(V.cells(spark, d), "purchase", steps)).select("step_h", "member", "cell", "value", "missing")
