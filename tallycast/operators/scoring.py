"""From stored forecasts to scores."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.functions import scoring as rules
from tallycast.functions.timing import horizon_days_calendar
from tallycast.operators.ranks import RUN_BITS, member_run, null_safe_join, quantile_parts, quantile_values, run_ranks
from tallycast.session import cut_lineage
from tallycast.schema import (
    FAMILY_PARAMETERS,
    OBS_KEY,
    SCORE_GROUP,
    SCORE_KEY,
    SCORE_VALUES,
    STATS,
    present,
)

#: Families whose scores are plain column arithmetic; the others call a vectorised function.
ARITHMETIC = ["normal", "lognormal", "logistic", "exponential", "uniform", "bernoulli"]
MAX_HORIZON_DAYS = 35


def sample_family(family: str = "family") -> Column:
    """Both names of an ensemble become ``sample``."""
    return F.when(F.col(family) == "ensemble", F.lit("sample")).otherwise(F.col(family))


def last_observed(targets: DataFrame) -> DataFrame:
    """The latest time that has an observation, as a one-row table."""
    return targets.where(F.col("observation").isNotNull()).agg(F.max("datetime").alias("last_observed"))


def eligible_forecasts(forecasts: DataFrame, targets: DataFrame, project: str, cutoff: Column) -> DataFrame:
    """Complete forecast rows of a project that may have an observation by now.

    The latest observation enters as a scalar subquery, so the bound reaches the scan as a filter.
    """
    newest = last_observed(targets).scalar()
    rows = forecasts.where(
        (F.col("project_id") == project)
        & (F.col("datetime") > cutoff)
        & (F.col("datetime") <= newest)
        & F.col("model_id").isNotNull()
        & F.col("parameter").isNotNull()
        & F.col("prediction").isNotNull()
    )
    return rows.withColumns({"family": sample_family(), "horizon": horizon_days_calendar()}).where(
        (F.col("duration") != "P1D") | (F.col("horizon") <= MAX_HORIZON_DAYS)
    )


def score_candidates(forecasts: DataFrame, scores: DataFrame, targets: DataFrame) -> DataFrame:
    """Forecast rows that are not scored yet and have an observation.

    A score row that was stored without an observation does not count as scored.
    Observations join first: the join drops rows, and the anti join then shuffles less. Members and scores are often
    made from fewer rows, which lets Spark take them for small, so neither join may broadcast.
    """
    observed = targets.where(F.col("observation").isNotNull()).select(*OBS_KEY, "observation")
    # a semi or anti join ignores repeats in its right side, so the keys are not made distinct first
    done = scores.where(F.col("observation").isNotNull()).select(*SCORE_KEY)
    return forecasts.join(observed.hint("merge"), OBS_KEY).join(done.hint("merge"), SCORE_KEY, "left_anti")


def fresh_scores(scores: DataFrame, targets: DataFrame, tolerance: float = 1e-2) -> DataFrame:
    """Scores whose observation still agrees with the targets; the rest are to be scored again."""
    now = targets.where(F.col("observation").isNotNull()).select(*OBS_KEY, F.col("observation").alias("_now"))
    change = F.try_divide(F.abs(F.col("observation") - F.col("_now")), F.abs(F.col("observation")))
    same = (change < tolerance) | ((F.col("observation") == 0) & (F.col("_now") == 0))
    return scores.join(now.hint("merge"), OBS_KEY).where(same).drop("_now")


def scoring_groups(candidates: DataFrame) -> DataFrame:
    """The distinct work units, for reporting; scoring itself needs no loop over them."""
    return (
        candidates.where(F.col("model_id").isNotNull())
        .select("project_id", "duration", "variable", "model_id", sample_family().alias("family"))
        .distinct()
    )


# --- samples ----------------------------------------------------------------------------------------------------


def _gathered_stats(summaries: bool, scored: bool) -> dict[str, Column]:
    """Scores and statistics of a sample from its sorted members ``_x``, their mean and spread."""
    x = F.col("_x")
    out: dict[str, Column] = {}
    if scored:
        y = F.col("observation")
        iqr = rules.sample_quantile(x, 0.75) - rules.sample_quantile(x, 0.25)
        width = rules.kernel_bandwidth(F.size(x), F.col("_sd"), iqr)
        out |= {"crps": rules.sample_crps(x, y), "logs": rules.sample_logs(x, y, width)}
    if summaries:
        out |= {"mean": F.col("_mean"), "median": rules.sample_quantile(x, 0.5), "sd": F.col("_sd")}
        out |= {name: rules.sample_quantile(x, q) for name, q in rules.LIMITS.items()}
    return out


def _merged_moments(runs: Column) -> Column:
    """Mean and standard deviation of a group from those of its runs (``n``, ``mean``, ``sd``)."""
    start = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mean", "m2")])

    def step(a: Column, r: Column) -> Column:
        n, gap = a["n"] + r["n"], r["mean"] - a["mean"]
        own = F.coalesce(r["sd"] * r["sd"], F.lit(0.0)) * (r["n"] - 1)
        return F.struct(
            n.alias("n"),
            (a["mean"] + gap * r["n"] / n).alias("mean"),
            (a["m2"] + own + gap * gap * a["n"] * r["n"] / n).alias("m2"),
        )

    def finish(a: Column) -> Column:
        return F.struct(a["mean"].alias("mean"), F.when(a["n"] > 1, F.sqrt(a["m2"] / (a["n"] - 1))).alias("sd"))

    return F.aggregate(F.array_sort(runs), start, step, finish)


def _run_stats(runs: DataFrame, keys: list[str], summaries: bool, scored: bool) -> DataFrame:
    """The same for forecasts of several runs, from the ranks of members across their runs.

    Runs and ranks are read several times, and stored, as are the results: the driver holds plans of few steps only,
    none of them twice.
    """
    runs = cut_lineage(runs, "several-runs")
    ranks = cut_lineage(run_ranks(runs, keys), "run-ranks")
    v, n = F.col("_v"), F.col("_n")
    quantiles = {"median": 0.5, **rules.LIMITS, "_q25": 0.25, "_q75": 0.75}
    parts = quantile_parts(quantiles)
    values = quantile_values(quantiles)
    if scored:
        y = F.col("observation")
        parts["_miss"] = F.sum(n * F.abs(v - y))
        parts["_spread"] = F.sum(v * n * (2 * F.col("_before") + n - F.col("_m")))
        parts["_near"] = F.min(F.abs(v - y))
        size = F.col("_size").cast("double")
        values["crps"] = F.col("_miss") / size - F.col("_spread") / (size * size)
    ranked = ranks.groupBy(*keys).agg(*[c.alias(c_name) for c_name, c in parts.items()])
    ranked = ranked.select(*keys, "_size", *(["_near"] if scored else []), *[c.alias(c_name) for c_name, c in values.items()])
    moments = F.collect_list(F.struct(F.size("_x").cast("double").alias("n"), F.col("_mean").alias("mean"), F.col("_sd").alias("sd")))
    merged = runs.groupBy(*keys).agg(_merged_moments(moments).alias("_moments"))
    base = null_safe_join(ranked, merged.select(*keys, "_moments.mean", "_moments.sd"), keys)
    out = [*keys]
    if scored:
        base = base.withColumn("_h", rules.kernel_bandwidth(F.col("_size"), F.col("sd"), F.col("_q75") - F.col("_q25")))
        kernel = null_safe_join(ranks, base.select(*keys, "_h", "_near"), keys)
        # relative to the nearest member, so that a far observation does not underflow
        z, near = (v - y) / F.col("_h"), F.col("_near") / F.col("_h")
        kernel = kernel.groupBy(*keys).agg(F.sum(n * F.exp((near * near - z * z) / 2)).alias("_sum"))
        near = F.col("_near") / F.col("_h")
        density = F.ln(F.col("_sum") / F.col("_size")) - F.ln("_h") - F.lit(0.5 * math.log(2 * math.pi))
        base = null_safe_join(base, kernel, keys).withColumn("logs", near * near / 2 - density)
        out += ["crps", "logs"]
    if summaries:
        out += STATS
    return cut_lineage(base.select(*out), "run-stats")


# --- all families ---------------------------------------------------------------------------------------------


def _parametric_stats(families: list[str], summaries: bool, scored: bool) -> dict[str, Column]:
    """Scores and statistics of parametric forecasts from their parameters ``_p_*``."""

    def pick(per_family: dict[str, Column]) -> Column:
        column = F.lit(None).cast("double")
        for family, value in per_family.items():
            column = F.when(F.col("family") == family, value).otherwise(column)
        return column

    params = {f: {n: F.col(f"_p_{n}") for n in FAMILY_PARAMETERS[f]} for f in families}
    out: dict[str, Column] = {}
    if scored:
        y = F.col("observation")
        out["crps"] = pick({f: rules.CRPS[f](params[f], y) for f in families})
        out["logs"] = pick({f: rules.LOGS[f](params[f], y) for f in families})
    if summaries:
        stats = {f: rules.PARAMETRIC_STATS[f](params[f]) for f in families}
        out |= {s: pick({f: stats[f][s] for f in families}) for s in STATS}
    return out


def _by_family(rows: DataFrame, keys: list[str], summaries: bool, scored: bool, run_bits: int, families: list[str]) -> DataFrame:
    """One row per forecast with its scores and statistics.

    One aggregate turns members into sorted runs and parameters into columns, for all families at once. A run has the
    members of ``2 ** run_bits`` consecutive numbers, so it is bounded whatever a forecast's size, and reduced where the
    rows are read. Runs are stored: the input is read once, and each kind of family then reads its own forecasts from
    that small table, so a function in Python sees no others. The run of most forecasts is their only one.
    """
    named = rows.withColumn("family", sample_family()).where(F.col("family").isin(families))
    known = named.where((F.col("family") != "sample") | F.col("prediction").isNotNull())
    parametric = [f for f in families if f != "sample"]
    names = sorted({name for family in parametric for name in FAMILY_PARAMETERS[family]})
    is_member = F.col("family") == "sample"
    run = F.when(is_member, member_run(F.col("parameter"), run_bits)).otherwise(F.lit(0).cast("long"))
    member = F.when(is_member, F.col("prediction"))
    wide = known.groupBy(*keys, run.alias("_run")).agg(
        F.sort_array(F.collect_list(member)).alias("_x"),
        F.avg(member).alias("_mean"),
        F.stddev_samp(member).alias("_sd"),
        *[F.max(F.when(F.col("parameter") == n, F.col("prediction"))).alias(f"_p_{n}") for n in names],
    )
    kinds = [k for k in [[f for f in parametric if f in ARITHMETIC]] if k] + [[f] for f in parametric if f not in ARITHMETIC]
    if "sample" in families or len(kinds) > 1:
        wide = cut_lineage(wide, "forecast-runs")
    parts = []
    if "sample" in families:
        runs = wide.where(is_member).select(*keys, "_run", "_x", "_mean", "_sd", F.xxhash64(*keys).alias("_g"))
        further = runs.where(F.col("_run") != 0)
        stats = _gathered_stats(summaries, scored)
        # the stored files' own statistics tell where there are none, and nothing is joined then
        if not further.isEmpty():
            # a hash in common can only call one run several
            several = further.select("_g").distinct()
            parts.append(_run_stats(runs.join(several, "_g", "left_semi"), keys, summaries, scored))
            runs = runs.join(several, "_g", "left_anti")
        parts.append(runs.select(*keys, *[c.alias(n) for n, c in stats.items()]))
    for kind in kinds:
        stats = _parametric_stats(kind, summaries, scored)
        parts.append(wide.where(F.col("family").isin(kind)).select(*keys, *[c.alias(n) for n, c in stats.items()]))
    return reduce(DataFrame.unionByName, parts)


def score_joined(joined: DataFrame, include_summaries: bool = True, run_bits: int = RUN_BITS) -> DataFrame:
    """Score every forecast that is joined to its observation: CRPS, log score and summary statistics.

    Rows are split by kind of family before anything else, so ``parameter`` is only ever read as what it is.
    """
    keys = [*present(SCORE_GROUP, joined), "observation"]
    return _by_family(joined, keys, include_summaries, True, run_bits, ["sample", *FAMILY_PARAMETERS])


def summarize_forecast(forecasts: DataFrame, run_bits: int = RUN_BITS) -> DataFrame:
    """Mean, median, spread and limits of every forecast; no observation needed."""
    return _by_family(forecasts, present(SCORE_GROUP, forecasts), True, False, run_bits, ["sample", *FAMILY_PARAMETERS])


def score_family(joined: DataFrame, family: str, rule: str) -> DataFrame:
    """A single rule (``crps`` or ``logs``) for a single family."""
    keys = [*present(SCORE_GROUP, joined), "observation"]
    return _by_family(joined, keys, False, True, RUN_BITS, [family]).select(*keys, rule)


# --- keeping the score table --------------------------------------------------------------------------------


def score_union(scores: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows without exact repeats."""
    return scores.unionByName(new).distinct()


def score_upsert(scores: DataFrame, new: DataFrame) -> DataFrame:
    """New scores replace old ones of the same forecast issue, so a revised observation leaves no stale row."""
    keys = present(SCORE_GROUP, scores)
    keep = keys + [c for c in SCORE_VALUES if c in scores.columns]
    right = new.select(*[F.col(k).alias(f"_n_{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_n_{k}"))
    # new scores are often made from fewer rows, which lets Spark take them for small
    return scores.select(*keep).join(right.hint("merge"), on, "left_anti").unionByName(new.select(*keep))


def score_checks(scores: DataFrame) -> DataFrame:
    """Row count, number of (duration, variable, model) groups and the time range of a score table."""
    per_group = scores.groupBy("duration", "variable", "model_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("reference_datetime").alias("first_fc"),
        F.max("reference_datetime").alias("last_fc"),
        F.min("datetime").alias("first_prediction"),
        F.max("datetime").alias("last_prediction"),
    )
    return per_group.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_groups"),
        F.min("first_fc").alias("first_fc"),
        F.max("last_fc").alias("last_fc"),
        F.min("first_prediction").alias("first_prediction"),
        F.max("last_prediction").alias("last_prediction"),
    )
