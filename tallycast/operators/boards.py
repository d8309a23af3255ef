"""Leaderboards and the tables behind the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.functions.timing import floor_to, horizon_days_exact, ntz
from tallycast.operators.ranks import exact_quantiles
from tallycast.schema import OBS_KEY

MAX_DAYS = 35
NARROW = ["variable", "model_id", "site_id", "datetime", "reference_datetime", "observation", "mean"]
LIMITS_95 = ["quantile02_5", "quantile97_5"]


def with_site_location(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows at registered sites, with their place."""
    return df.join(sites.withColumnRenamed("field_site_id", "site_id"), "site_id")


def latest_forecasts(summaries: DataFrame, sites: DataFrame, today: Column, lag_days: int = 2) -> DataFrame:
    """Per duration and variable the newest forecast issued before ``today - lag_days``, at times after its issue."""
    issued = summaries.where(F.col("reference_datetime") < ntz(F.date_sub(today, lag_days)))
    newest = issued.groupBy("duration", "variable").agg(F.max("reference_datetime").alias("reference_datetime"))
    hidden = ["project_id", "family", "sd", "pub_datetime"]
    rows = summaries.where(F.col("datetime") > F.col("reference_datetime")).drop(*hidden)
    return with_site_location(rows.join(newest, ["duration", "variable", "reference_datetime"]), sites)


def recent_scores(
    scores: DataFrame, sites: DataFrame, today: Column, after_days: int, before_days: int | None = None
) -> DataFrame:
    """Scores of forecasts issued after ``today - after_days`` (and before ``today - before_days``)."""
    rows = scores.where(F.col("reference_datetime") > ntz(F.date_sub(today, after_days)))
    extra = ["crps"]
    if before_days is not None:
        rows = rows.where(F.col("reference_datetime") < ntz(F.date_sub(today, before_days)))
        extra = []
    at_sites = rows.join(
        sites.select(F.col("field_site_id").alias("site_id")), "site_id", "left_semi"
    )  # the place itself is not reported
    return at_sites.select(*NARROW, *LIMITS_95, *extra)


def horizon_filter(df: DataFrame, cutoff: float, unit_days: float = 1.0) -> DataFrame:
    """Lead time in the chosen unit, kept where 0 < lead <= cutoff."""
    rows = df.withColumn("horizon", horizon_days_exact() / F.lit(unit_days))
    return rows.where((F.col("horizon") > 0) & (F.col("horizon") <= cutoff))


def leaderboard(scores: DataFrame, by: list[str], *, last_day: bool = False) -> DataFrame:
    """Mean CRPS per group over lead times in (0, 35) days, or (0, 35] with ``last_day``."""
    lead = horizon_days_exact()
    rows = scores.withColumn("horizon", lead).where(F.col("horizon") > 0)
    rows = rows.where(F.col("horizon") <= MAX_DAYS if last_day else F.col("horizon") < MAX_DAYS)
    return rows.groupBy(*by).agg(F.avg("crps").alias("crps"))


#: Forecasts of unlike durations are never averaged with each other.
BOARD = ["duration", "variable", "model_id"]


def leaderboard_by_model(scores: DataFrame) -> DataFrame:
    return leaderboard(scores, BOARD)


def leaderboard_by_reference(scores: DataFrame) -> DataFrame:
    return leaderboard(scores, [*BOARD, "reference_datetime"], last_day=True)


def leaderboard_by_horizon(scores: DataFrame) -> DataFrame:
    return leaderboard(scores, [*BOARD, "horizon"])


def leaderboard_weekly(scores: DataFrame, excluded: list[str]) -> DataFrame:
    """The three boards from raw scores in one table; ``board`` names the grouping.

    Grouping sets read and aggregate the scores once for all three.
    """
    rows = board_filter(scores.where(F.col("observation").isNotNull()), excluded=excluded)
    rows = rows.withColumn("horizon", horizon_days_exact()).where(
        (F.col("horizon") > 0) & (F.col("horizon") <= MAX_DAYS)
    )
    strict = F.when(F.col("horizon") < MAX_DAYS, F.col("crps"))
    reference, horizon = F.col("reference_datetime"), F.col("horizon")
    board_keys = [F.col(c) for c in BOARD]
    grouped = rows.groupingSets(
        [board_keys, [*board_keys, reference], [*board_keys, horizon]], *board_keys, reference, horizon
    ).agg(
        F.grouping("reference_datetime").alias("_all_references"),
        F.grouping("horizon").alias("_all_horizons"),
        F.avg("crps").alias("_to_last_day"),
        F.avg(strict).alias("_before_last_day"),
        F.count(F.when(F.col("horizon") < MAX_DAYS, 1)).alias("_inside"),
    )
    by_reference = F.col("_all_references") == 0
    board = F.when(by_reference, "reference").when(F.col("_all_horizons") == 0, "horizon").otherwise("model")
    return grouped.where(by_reference | (F.col("_inside") > 0)).select(
        board.alias("board"),
        *BOARD,
        "reference_datetime",
        "horizon",
        F.when(by_reference, F.col("_to_last_day")).otherwise(F.col("_before_last_day")).alias("crps"),
    )


def board_filter(
    df: DataFrame,
    variable: str | None = None,
    sites: list[str] | None = None,
    excluded: list[str] | None = None,
    until: Column | None = None,
) -> DataFrame:
    """The selection a reader makes on a board."""
    if variable is not None:
        df = df.where(F.col("variable") == variable)
    if sites is not None:
        df = df.where(F.col("site_id").isin(sites))
    if excluded:
        df = df.where(~F.col("model_id").isin(excluded))
    if until is not None:
        df = df.where(F.col("datetime") <= until)
    return df


def model_order(scores: DataFrame) -> DataFrame:
    """Models by median CRPS, largest first."""
    medians = exact_quantiles(scores, ["model_id"], "crps", {"median_crps": 0.5})
    # one row per model is left here
    return medians.withColumn("position", F.dense_rank().over(Window.orderBy(F.desc("median_crps"))))


def missing_scores(scores: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose every score is missing; a report should refuse them."""
    known = F.when(~F.isnan("crps"), F.col("crps"))
    return scores.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count(known).alias("_ok")).where("_ok = 0").drop("_ok")


def missing_score_guard(scores: DataFrame) -> DataFrame:
    """The scores unchanged; the job fails if a model has none at all."""
    absent = missing_scores(scores, ["model_id"]).agg(F.count(F.lit(1))).scalar()
    message = F.lit("a model has only missing scores")
    return scores.where(F.when(absent > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def earliest_reference(df: DataFrame) -> DataFrame:
    """All rows of the earliest issue time."""
    return df.where(F.col("reference_datetime") == df.agg(F.min("reference_datetime")).scalar())


def class_leaderboard(scores: DataFrame, models: list[str], start: Column, site: str) -> DataFrame:
    rows = scores.where(
        F.col("model_id").isin(models) & (F.col("reference_datetime") >= start) & (F.col("site_id") == site)
    )
    return rows.groupBy("model_id").agg(F.avg("crps").alias("crps")).orderBy("crps")


def submissions(forecasts: DataFrame) -> DataFrame:
    return forecasts.select("model_id", "variable", "duration", "reference_datetime").distinct()


def submission_stats(forecasts: DataFrame) -> DataFrame:
    # per model first: only one small row per model and variable reaches the last step
    per = submissions(forecasts).groupBy("model_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("n_submissions"), F.count("model_id").alias("n_models"))


def target_extent(targets: DataFrame) -> DataFrame:
    per = (
        targets.where(F.col("observation").isNotNull())
        .groupBy("variable")
        .agg(F.min("datetime").alias("a"), F.max("datetime").alias("b"))
    )
    ends = per.agg(
        F.min("a").alias("first"), F.max("b").alias("last"), F.count(F.lit(1)).alias("n_variables")
    )
    return ends.withColumn("years", F.date_diff("last", "first") / F.lit(365.25))


def variable_table(targets: DataFrame, descriptions: DataFrame) -> DataFrame:
    pairs = targets.select("variable", "duration").distinct()
    return pairs.join(descriptions, ["variable", "duration"], "left")


#: Durations the reports count.
REPORTED = ["P1D", "P1W"]


def at_registered(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows of reported durations at registered sites (``field_site_id``)."""
    return only_registered(df.where(F.col("duration").isin(REPORTED)), sites)


def only_registered(df: DataFrame, sites: DataFrame) -> DataFrame:
    return df.join(sites.select(F.col("field_site_id").alias("site_id")), "site_id", "left_semi")


def submissions_per_month(scores: DataFrame, sites: DataFrame, start: Column, end: Column) -> DataFrame:
    """Submissions scored at registered sites by month of issue; one at several sites counts at each."""
    rows = at_registered(scores, sites)
    rows = rows.where((F.col("reference_datetime") >= start) & (F.col("reference_datetime") < end))
    rows = rows.select("model_id", "variable", "duration", "reference_datetime", "site_id").distinct()
    return rows.groupBy(floor_to("month", "reference_datetime").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def submission_counts(
    scores: DataFrame,
    sites: DataFrame,
    weekly: list[str],
    months: int,
    excluded: list[str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Submissions, forecast-observation pairs and models, per variable and in total, at registered sites.

    Excluded variables are not counted, but the total of models has the models of those too. One pass: pairs are
    reduced to submissions with their number of pairs, these to sites and models. Rows are dealt out once, to ``tasks``
    tasks, for all of these steps; only what is left of a site and model meets the registered sites.
    """
    dealt = ["site_id", "variable", "model_id"]
    rows = scores.where(F.col("duration").isin(REPORTED)).repartition(*([tasks] if tasks else []), *dealt)
    pairs = rows.select("model_id", "reference_datetime", "variable", "duration", "site_id", "datetime").distinct()
    per_submission = pairs.groupBy("model_id", "variable", "reference_datetime", "duration", "site_id").agg(
        F.count(F.lit(1)).alias("pairs")
    )
    per_site = per_submission.groupBy(*dealt).agg(F.sum("pairs").alias("pairs"), F.count(F.lit(1)).alias("submissions"))
    per_model = only_registered(per_site, sites).groupBy("model_id", "variable").agg(
        F.sum("pairs").alias("pairs"), F.sum("submissions").alias("submissions")
    )
    left_out = F.coalesce(F.col("variable").isin(excluded or []), F.lit(False))
    counts = per_model.withColumn("_out", left_out).rollup("variable").agg(
        F.grouping("variable").alias("total"),
        F.bool_and("_out").alias("_out"),
        F.sum(F.when(~F.col("_out"), F.col("submissions"))).alias("submissions"),
        F.sum(F.when(~F.col("_out"), F.col("pairs"))).alias("pairs"),
        F.count_distinct("model_id").alias("models"),
    )
    counts = counts.where((F.col("total") == 1) | ~F.col("_out")).drop("_out")
    long = counts.unpivot(["variable", "total"], ["submissions", "pairs", "models"], "kind", "n")
    frequency = F.when(F.col("variable").isin(weekly), "weekly").otherwise("daily")
    is_total = F.col("total") == 1
    return long.select(
        F.when(is_total, "all").otherwise(F.col("variable")).alias("variable"),
        "kind",
        "n",
        F.when(~is_total, frequency).alias("frequency"),
        F.when(is_total & (F.col("kind") == "submissions"), F.col("n") / F.lit(float(months))).alias("per_month"),
    )


def total_rows(
    targets: DataFrame, scores: DataFrame, forecasts: DataFrame, sites: DataFrame, until: Column, start: Column, end: Column
) -> DataFrame:
    """Observations, scored forecasts and forecast members at registered sites, counted and added."""

    def inside(df):
        kept = at_registered(df, sites)
        return kept.where((F.col("reference_datetime") >= start) & (F.col("reference_datetime") < end))

    key = ["reference_datetime", "model_id", "variable", "duration", "datetime", "site_id"]
    count = F.count(F.lit(1)).alias("n")
    parts = {
        "targets": at_registered(targets, sites).where((F.col("datetime") < until) & F.col("observation").isNotNull()),
        "scored": inside(scores).select(*key).distinct(),
        "members": inside(forecasts).select(*key, "parameter").distinct(),
    }
    counted = None
    for kind, df in parts.items():
        one = df.agg(count).withColumn("kind", F.lit(kind))
        counted = one if counted is None else counted.unionByName(one)
    return counted.rollup("kind").agg(F.sum("n").alias("n")).select(
        F.coalesce("kind", F.lit("total")).alias("kind"), "n"
    )


def trajectory(forecasts: DataFrame, targets: DataFrame, reference: Column, site: str, members: int = 150) -> DataFrame:
    """The members of one forecast beside the observations."""
    rows = forecasts.where((F.col("reference_datetime") == reference) & (F.col("site_id") == site))
    rows = rows.where(F.col("parameter").try_cast("int") < members)
    return rows.join(targets, OBS_KEY, "left")


def lead_times(forecasts: DataFrame, targets: DataFrame, at: Column, site: str, members: int = 150) -> DataFrame:
    """Everything that was ever forecast for one time, with its lead."""
    rows = forecasts.where((F.col("datetime") == at) & (F.col("site_id") == site))
    rows = rows.where(F.col("parameter").try_cast("int") < members).withColumn("horizon", horizon_days_exact())
    return rows.join(targets, OBS_KEY, "left")


def latest_by_site(scores: DataFrame) -> DataFrame:
    """Rows of each model's newest issue at each site."""
    newest = scores.groupBy("model_id", "site_id").agg(F.max("reference_datetime").alias("reference_datetime"))
    return scores.join(newest, ["model_id", "site_id", "reference_datetime"], "left_semi")


def latest_full_horizon(scores: DataFrame, today: Column, lag_days: int = 30) -> DataFrame:
    """Per model and site, the newest issue among those that reach furthest ahead."""
    old = scores.where(F.col("reference_datetime") < ntz(F.date_sub(today, lag_days)))
    reach = old.groupBy("model_id", "site_id", "reference_datetime").agg(F.max("datetime").alias("_last"))
    reach = reach.withColumn("max_horizon", F.date_diff("_last", "reference_datetime"))
    best = reach.groupBy("model_id", "site_id").agg(
        F.max(F.struct("max_horizon", "reference_datetime")).alias("best")
    )
    return best.select("model_id", "site_id", "best.reference_datetime", "best.max_horizon")


def score_vs_baseline(scores: DataFrame, baseline: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A model's scores beside the baseline's; baseline rows without a counterpart stay.

    ``skill`` is 1 - crps / baseline crps.
    """
    keys = by or ["site_id", "reference_datetime", "datetime", "variable"]
    base = baseline.select(*keys, F.col("crps").alias("clim_crps"))
    rows = scores.select(*keys, "model_id", "crps").join(base, keys, "right")
    return rows.withColumn("skill", 1 - F.try_divide(F.col("crps"), F.col("clim_crps")))
