"""Ensemble statistics, totals, probabilities and completeness reports. NaN counts as missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import N_MEMBERS, THRESHOLDS_MM
from ..sources.scratch import delete_table, shared_table


def real(column: str = "value") -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None))


def ensemble_stats(cells: DataFrame, keys: tuple[str, ...] = ("varname", "step_h", "cell")) -> DataFrame:
    v = real()
    return cells.groupBy(*keys).agg(F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_pop(v), 6).alias("std"), F.max(v).alias("max"), F.min(v).alias("min"))


def with_thresholds(df: DataFrame, thresholds: list[float] = THRESHOLDS_MM) -> DataFrame:
    return df.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))


def exceedance_prob(totals: DataFrame, keys: tuple[str, ...] = ("varname", "day", "cell"), thresholds: list[float] = THRESHOLDS_MM, value: str = "value") -> DataFrame:
    """Percent of members at or over each threshold; NaN does not exceed but counts as a member."""
    counts = [F.count_if(real(value) >= t).alias(str(i)) for i, t in enumerate(thresholds)]
    wide = totals.groupBy(*keys).agg(F.count("*").alias("n"), *counts)
    long = F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(str(i)).alias("hits")) for i, t in enumerate(thresholds))))
    return wide.select(*keys, "n", long.alias("t")).select(*keys, "t.threshold", F.round(100.0 * F.col("t.hits") / F.col("n"), 6).alias("probability"))


def exceedance_prob_valid(totals: DataFrame, keys: tuple[str, ...] = ("varname", "day", "cell"), thresholds: list[float] = THRESHOLDS_MM, value: str = "value") -> DataFrame:
    """Percent of the members that have any value at all (over the whole variable)."""
    alive = totals.where(real(value).isNotNull()).groupBy(keys[0]).agg(F.count_distinct("member").alias("n"))
    counts = [F.count_if(real(value) >= t).alias(str(i)) for i, t in enumerate(thresholds)]
    wide = totals.groupBy(*keys).agg(*counts).join(alive, keys[0])
    long = F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(str(i)).alias("hits")) for i, t in enumerate(thresholds))))
    return wide.select(*keys, "n", long.alias("t")).select(*keys, "t.threshold", F.round(100.0 * F.col("t.hits") / F.col("n"), 6).alias("probability"))


def step_exceedance(cells: DataFrame, step_h: int) -> DataFrame:
    return exceedance_prob(cells.where(F.col("step_h") == step_h), ("varname", "step_h", "cell"))


def accumulate_24h(cells: DataFrame, keys: tuple[str, ...] = ("varname", "member", "cell")) -> DataFrame:
    """Sums of each 8 steps of 3 hours, complete days only; NaN makes a sum NaN."""
    day = F.floor(F.col("step_h") / 24).cast("int")
    return cells.groupBy(*keys, day.alias("day")).agg(F.count("*").alias("n"), F.sum("value").alias("total")).where("n = 8").drop("n")


def accumulate_24h_fc(cells: DataFrame, keys: tuple[str, ...] = ("varname", "member", "cell")) -> DataFrame:
    """Sums of steps 3 to 24, 27 to 48, ... hours, complete days only; missing counts as 0; day d ends at 24 d hours."""
    day = F.ceil(F.col("step_h") / 24).cast("int")
    value = F.coalesce(F.nanvl(F.col("value").cast("double"), F.lit(0.0)), F.lit(0.0)).cast("decimal(18,2)")
    total = F.sum(value).cast("double").alias("value")
    return cells.where("step_h > 0").groupBy(*keys, day.alias("day")).agg(F.count("*").alias("n"), total).where("n = 8").drop("n")


def prob_summary(probabilities: DataFrame) -> DataFrame:
    return probabilities.groupBy("varname", "day", "threshold").agg(F.max("probability").alias("max_probability"), F.count_if(F.col("probability") >= 50).alias("cells_50"))


def percentile_thresholds(cells: DataFrame, at: tuple[float, ...] = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99), small: int = 100_000) -> DataFrame:
    """Exact percentiles of each variable, between neighbouring values in proportion; null where a variable has no value.

    Selection in rounds: a mergeable sketch gives bounds within each interval that holds a wanted rank, counts within the
    bounds give the interval of the next round, until an interval has at most `small` values or one different value. No task holds more
    values than that; a bound is a value of the data and a class of its own, so each round leaves less, ties included.
    Values are worked out once and written, as each round reads them; the rounds' tables have a row for each wanted rank.
    """
    values = shared_table(cells.select("varname", real().alias("v")), "values")
    known = values.where("v IS NOT NULL")
    whole = known.groupBy("varname").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    places = F.array(*(F.struct(F.floor((F.col("n") - 1) * p + up).alias("rank")) for p in at for up in (0, 1)))
    fields = ["varname", "rank", "lo", "hi", "below", "n_in"]
    ranks = whole.withColumn("rank", F.explode(F.array_distinct(places))).withColumn("rank", F.least(F.col("rank.rank"), F.col("n") - 1))
    wanted = shared_table(ranks.select("varname", "rank", "lo", "hi", F.lit(0).cast("bigint").alias("below"), F.col("n").alias("n_in")).distinct(), "ranks")
    open_ = (F.col("n_in") > small) & (F.col("lo") < F.col("hi"))
    while not wanted.where(open_).isEmpty():
        wanted = shared_table(wanted.where(~open_).unionByName(_narrowed(known, wanted.where(open_)).select(*fields)), "ranks")
    rest = wanted.where("lo < hi").select("varname", "lo", "hi").distinct()
    inside = known.join(rest, (known["varname"] == rest["varname"]) & (known["v"].between(rest["lo"], rest["hi"]))).select(known["varname"], "lo", "v")
    sorted_ = inside.groupBy("varname", "lo").agg(F.sort_array(F.collect_list("v")).alias("vs"))  # at most `small`
    found = wanted.join(sorted_, ["varname", "lo"], "left").select("varname", "rank", F.when(F.col("lo") < F.col("hi"), F.get("vs", (F.col("rank") - F.col("below")).cast("int"))).otherwise(F.col("lo")).alias("v"))
    by_rank = shared_table(found.groupBy("varname").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("m")).join(whole.select("varname", "n"), "varname"), "selected")
    names = shared_table(values.select("varname").distinct(), "names")
    delete_table(values)
    h = lambda p: (F.col("n") - 1) * F.lit(p)
    value = lambda p, up: F.col("m")[F.least(F.floor(h(p)) + up, F.col("n") - 1)]
    between = lambda p: value(p, 0) + (value(p, 1) - value(p, 0)) * (h(p) - F.floor(h(p)))
    return names.join(by_rank, "varname", "left").select("varname", *(F.round(between(p), 6).alias(f"p{round(100 * p)}") for p in at))


def _narrowed(known: DataFrame, wanted: DataFrame, parts: int = 64) -> DataFrame:
    """The wanted ranks, each in the part of its interval that holds it."""
    spans = wanted.select("varname", "lo", "hi").distinct()
    within = lambda s: known.withColumnRenamed("varname", "_name").join(s, (F.col("_name") == F.col("varname")) & F.col("v").between(F.col("lo"), F.col("hi")))
    bounds = within(spans).groupBy("varname", "lo", "hi").agg(F.percentile_approx("v", [k / parts for k in range(1, parts)], 1000).alias("bounds"))
    bounded = shared_table(bounds.withColumn("bounds", F.array_distinct("bounds")), "bounds")
    place = F.size(F.filter("bounds", lambda b: b < F.col("v"))) + F.size(F.filter("bounds", lambda b: b <= F.col("v")))
    counts = within(bounded).groupBy("varname", "lo", "hi", place.alias("part")).agg(F.count("*").alias("k"), F.min("v").alias("low"), F.max("v").alias("high"))
    before = F.sum("k").over(Window.partitionBy("varname", "lo", "hi").orderBy("part")) - F.col("k")  # at most 2 x parts rows
    met = wanted.join(counts.withColumn("before", before), ["varname", "lo", "hi"])
    met = met.where((F.col("rank") >= F.col("below") + F.col("before")) & (F.col("rank") < F.col("below") + F.col("before") + F.col("k")))
    return met.select("varname", "rank", F.col("low").alias("lo"), F.col("high").alias("hi"), (F.col("below") + F.col("before")).alias("below"), F.col("k").alias("n_in"))


def compare_stats(aligned: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Differences of two aligned columns a and b."""
    d = F.col("a") - F.col("b")
    rel = F.abs(d) / (F.abs(F.col("a")) + 1e-10)
    out = aligned.where("a IS NOT NULL AND b IS NOT NULL").agg(
        F.round(F.avg(d), 6).alias("mean_diff"), F.round(F.stddev_pop(d), 6).alias("std_diff"), F.round(F.max(F.abs(d)), 6).alias("max_abs"), F.round(F.min(F.abs(d)), 6).alias("min_abs"),
        F.round(F.sqrt(F.avg(d * d)), 6).alias("rmse"), F.round(F.max(rel), 6).alias("max_rel"), F.round(F.avg(rel), 6).alias("mean_rel"),
    )
    return out.withColumn("match", F.col("max_rel") < tolerance)


def skill_stats(aligned: DataFrame, by: str = "step_h") -> DataFrame:
    """Correlation (null without variance), RMSE, MAE, largest difference and relative error, for each `by` and pooled (null)."""
    d = F.col("a") - F.col("b")
    return aligned.where("a IS NOT NULL AND b IS NOT NULL").rollup(by).agg(
        F.round(F.covar_pop("a", "b") / F.nullif(F.stddev_pop("a") * F.stddev_pop("b"), F.lit(0.0)), 6).alias("r"), F.round(F.sqrt(F.avg(d * d)), 6).alias("rmse"), F.round(F.avg(F.abs(d)), 6).alias("mae"), F.round(F.max(F.abs(d)), 6).alias("max_abs"),
        F.round(F.avg(F.abs(d)) / F.greatest(F.avg(F.abs("b")), F.lit(1e-12)) * 100, 6).alias("rel_percent"), F.count("*").alias("n"),
    )


def pair_summary(pairs: DataFrame, first: int = 5) -> DataFrame:
    """Percent of files found, sizes, and the first files that miss a part."""
    missing = F.when(~F.col("both_exist"), F.col("file"))
    pct = lambda c: F.round(100.0 * F.count_if(F.col(c)) / F.count("*"), 6)
    totals = pairs.agg(
        pct("grb2_exists").alias("grb2_percent"), pct("idx_exists").alias("idx_percent"), pct("both_exist").alias("both_percent"), F.sum(F.col("grb2_size_mb").cast("decimal(18,2)")).cast("double").alias("total_mb"),
        F.round(F.avg("grb2_size_mb"), 6).alias("mean_mb"), F.count(missing).alias("n_missing"),
    )
    top = pairs.where("NOT both_exist").select("file").orderBy("file").limit(first).agg(F.array_join(F.sort_array(F.collect_list("file")).cast("array<string>"), ",").alias("first_missing"))
    return totals.crossJoin(F.broadcast(top))  # one row each


def unique_groups(chunks: DataFrame) -> DataFrame:
    """Levels of each (varname, stepType, typeOfLevel); a single one is a scalar coordinate."""
    out = chunks.groupBy("varname", "stepType", "typeOfLevel").agg(F.sort_array(F.collect_set("level")).alias("levels"), F.count_distinct("level").alias("n_levels"))
    return out.select("varname", "stepType", "typeOfLevel", F.array_join(F.transform("levels", lambda x: x.cast("int").cast("string")), ",").alias("levels"), "n_levels", (F.col("n_levels") == 1).alias("scalar"))


def uniqueness_check(index: DataFrame, keys: tuple[str, ...] = ("file", "attrs"), mode: str = "report") -> DataFrame:
    """Keys that occur more than once; in mode 'fail' the first stops the job."""
    bad = index.groupBy(*keys).agg(F.count("*").alias("n"), F.min("idx").alias("first_idx")).where("n > 1")
    return bad if mode == "report" else bad.withColumn("n", F.raise_error(F.lit("attributes are not unique")).cast("bigint"))


def member_profile(messages: DataFrame) -> DataFrame:
    """Rows by member, and in all (`overall`): files, share of rows without a number, different members and their range."""
    without = F.round(F.count_if(F.col("number").isNull()) / F.count("*"), 6)
    return messages.rollup("number").agg((F.grouping_id() == 1).alias("overall"), F.count("*").alias("n"), F.count_distinct("file").alias("files"), without.alias("null_share"), F.min("number").alias("low"), F.max("number").alias("high"))


def param_profile(messages: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent parameters and level types."""
    sets = messages.groupingSets([["code"], ["level_no"]], "code", "level_no").agg(F.count("*").alias("n"))
    kind = F.when(F.col("code").isNotNull(), "param").otherwise("level")
    named = sets.select(kind.alias("kind"), F.coalesce("code", F.col("level_no").cast("string")).alias("name"), "n")
    return named.withColumn("rank", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "name"))).where(F.col("rank") <= n)


def param_members_min(messages: DataFrame) -> DataFrame:
    """Lowest member of each parameter and level; the control is -1."""
    return messages.groupBy("code", "level_no").agg(F.min(F.when(F.col("number") == 0, -1).otherwise(F.col("number"))).alias("member"))


def member_completeness(messages: DataFrame, expected: int = N_MEMBERS) -> DataFrame:
    """Members that each run date should have and lacks."""
    runs = messages.select(F.to_date("run_time").alias("run_date"), "number").distinct()
    got = runs.groupBy("run_date").agg(F.collect_set("number").alias("have"))
    missing = F.array_except(F.sequence(F.lit(0), F.lit(expected - 1)), F.col("have"))
    return got.select("run_date", F.size("have").alias("n_members"), F.size(missing).alias("n_missing"), F.array_join(F.transform(F.array_sort(missing), lambda x: x.cast("string")), ",").alias("missing"))


def index_validation(messages: DataFrame, least: int = 50) -> DataFrame:
    out = messages.groupBy(F.to_date("run_time").alias("run_date")).agg(F.count("*").alias("n_messages"), F.count_distinct("number").alias("n_members"))
    return out.withColumn("valid", F.col("n_members") >= least)


def step_completeness(messages: DataFrame, expected: list[int]) -> DataFrame:
    got = messages.groupBy("number").agg(F.collect_set("step_h").alias("have"))
    missing = F.array_except(F.array(*map(F.lit, expected)), F.col("have"))
    return got.select("number", F.size("have").alias("n_steps"), F.size(missing).alias("n_missing"), F.array_min(missing).alias("first_missing"))


def field_completeness(messages: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected fields (code, level_no) with whether any message has them, and how many."""
    got = messages.groupBy("code", "level_no").agg(F.count("*").alias("n"))
    return expected.join(got, ["code", "level_no"], "left").select("code", "level_no", F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNotNull().alias("available"))


def store_profile(refs: DataFrame) -> DataFrame:
    """Keys by their first part and depth (5 and more together), and how many of them name an ensemble member."""
    parts = F.split("key", "/")
    member = F.col("key").rlike(r"(^|/)(number/\d+|number_\d+|ens_?\d+|control)(/|$)")
    return refs.groupBy(F.get(parts, 0).alias("first"), F.least(F.size(parts) - 1, F.lit(5)).alias("depth")).agg(F.count("*").alias("n"), F.count_if(member).alias("n_ensemble"))


def compare_profiles(one: DataFrame, two: DataFrame) -> DataFrame:
    """Profiles of two stores side by side; 0 where a store has no such keys."""
    a, b = (store_profile(x).select("first", "depth", *(F.col(c).alias(f"{c}_{k}") for c in ("n", "n_ensemble"))) for k, x in ((1, one), (2, two)))
    return a.join(b, ["first", "depth"], "full_outer").na.fill(0)


def nan_diagnostics(cells: DataFrame) -> DataFrame:
    """Missing and finite counts and statistics by variable and step, and by variable (step null)."""
    v = real()
    out = cells.rollup("varname", "step_h").agg(F.count("*").alias("total"), F.count_if(F.isnan("value")).alias("n_nan"), F.count(v).alias("n_finite"), F.min(v).alias("low"), F.max(v).alias("high"), F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_pop(v), 6).alias("std"))
    return out.where("varname IS NOT NULL").withColumn("unit_guess", F.when(F.col("high") < 1, "m").otherwise("mm"))


def run_summary(messages: DataFrame) -> DataFrame:
    """Files, bytes, control and perturbed members of each run date, and how many files of each member hold messages of some length."""
    dated = messages.withColumn("run_date", F.to_date("run_time"))
    by_member = dated.groupBy("run_date", "number").agg(F.count_distinct(F.when(F.col("length") > 0, F.col("file"))).alias("valid"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("number", "valid"))), lambda x: F.concat_ws(":", x["number"].cast("string"), x["valid"].cast("string"))), ",")
    totals = dated.groupBy("run_date").agg(F.count_distinct("file").alias("n_files"), F.sum("length").alias("bytes"), F.bool_or(F.col("number") == 0).alias("has_control"), F.count_distinct(F.when(F.col("number") > 0, F.col("number"))).alias("n_perturbed"))
    return totals.join(by_member.groupBy("run_date").agg(listed.alias("valid_files")), "run_date")


def spread_range(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"approx_range": F.round(2 * F.col("std"), 5), "spread": F.round(F.col("max") - F.col("min"), 6)})


def variable_inventory(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("varname").agg(F.count_distinct("step_h").alias("n_steps"), F.min("step_h").alias("first_step"), F.max("step_h").alias("last_step"), F.min("typeOfLevel").alias("typeOfLevel"), F.bool_or(F.col("typeOfLevel") == "isobaricInhPa").alias("isobaric"))


def daily_min_max(cells: DataFrame) -> DataFrame:
    """Minimum and maximum of each day's 6-hourly values."""
    six = cells.where("step_h % 6 = 0")
    return six.groupBy("varname", "member", "cell", F.floor(F.col("step_h") / 24).cast("int").alias("day")).agg(F.min("value").alias("tmin"), F.max("value").alias("tmax"))
