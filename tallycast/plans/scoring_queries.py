"""Queries on scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallycast.functions.scoring import LIMITS
from tallycast.functions.timing import ntz
from tallycast.operators import boards, scoring
from tallycast.plans.registry import query
from tallycast.plans.sqltext import GROUP, STATS, pdf, phi, sample_scores, wide
from tallycast.schema import BUNDLE_PARTITIONS, FAMILY_PARAMETERS, SCORE_GROUP
from tallycast.session import shared_folder
from tallycast.sources import tables

CUTOFF = "2024-01-03 00:00:00"
_cutoff = lambda: ntz(F.lit(CUTOFF))

STAT_NAMES = "mean median sd quantile97_5 quantile02_5 quantile90 quantile10"

_LAST = "SELECT max(datetime) AS last_observed FROM targets WHERE observation IS NOT NULL"
_ELIGIBLE = f"""
SELECT project_id, model_id, site_id, datetime, reference_datetime, duration, variable,
       CASE WHEN family = 'ensemble' THEN 'sample' ELSE family END AS family, parameter, prediction, pub_datetime,
       CAST(date_diff('day', reference_datetime, datetime) AS INTEGER) AS horizon
FROM forecasts
WHERE project_id = 'demo' AND datetime > TIMESTAMP '{CUTOFF}' AND datetime <= (SELECT last_observed FROM ({_LAST}) l)
  AND model_id IS NOT NULL AND parameter IS NOT NULL AND prediction IS NOT NULL
  AND NOT (duration = 'P1D' AND date_diff('day', reference_datetime, datetime) > 35)"""
_KEY = ["project_id", "site_id", "datetime", "duration", "variable"]
_SCORE_KEY = [*_KEY, "model_id", "family", "reference_datetime"]
_CANDIDATES = f"""
SELECT f.*, t.observation FROM ({_ELIGIBLE}) f
JOIN targets t ON {' AND '.join(f'f.{k} = t.{k}' for k in _KEY)} AND t.observation IS NOT NULL
WHERE NOT EXISTS (SELECT 1 FROM scores_old s
  WHERE {' AND '.join(f'f.{k} = s.{k}' for k in _SCORE_KEY)} AND s.observation IS NOT NULL)"""


def _eligible(inp):
    return scoring.eligible_forecasts(inp.forecasts, inp.targets, "demo", _cutoff())


def _candidates(inp):
    return scoring.score_candidates(_eligible(inp), inp.scores_old, inp.targets)


@query("last_observed", "targets", _LAST)
def _(inp):
    return scoring.last_observed(inp.targets)


@query("eligible_forecasts", "forecasts", _ELIGIBLE)
def _(inp):
    return _eligible(inp)


@query("score_candidates", "forecasts scores_old", _CANDIDATES)
def _(inp):
    return _candidates(inp)


@query(
    "stale_scores",
    "scores targets targets_new",
    f"""SELECT s.* FROM scores s JOIN (SELECT * FROM targets WHERE datetime < TIMESTAMP '2024-01-16 00:00:00'
        UNION ALL SELECT * FROM targets_new) t ON {' AND '.join(f's.{k} = t.{k}' for k in _KEY)}
        WHERE t.observation IS NOT NULL AND CASE WHEN s.observation = 0 THEN t.observation = 0
              ELSE abs(s.observation - t.observation) / abs(s.observation) < 0.01 END""",
)
def _(inp):
    # names the scores that stay; what it leaves out is scored again
    current = inp.targets.where(F.col("datetime") < ntz(F.lit("2024-01-16 00:00:00"))).unionByName(inp.targets_new)
    return scoring.fresh_scores(inp.scores, current)


@query(
    "scoring_groups",
    "joined",
    """SELECT DISTINCT project_id, duration, variable, model_id,
              CASE WHEN family = 'ensemble' THEN 'sample' ELSE family END AS family
       FROM joined WHERE model_id IS NOT NULL""",
)
def _(inp):
    return scoring.scoring_groups(inp.joined)


@query("crps_sample", "joined", sample_scores("joined", f"{GROUP}, observation, crps"), "crps")
def _(inp):
    return scoring.score_family(inp.joined, "sample", "crps")


@query("logs_sample", "joined", sample_scores("joined", f"{GROUP}, observation, logs"), "logs")
def _(inp):
    return scoring.score_family(inp.joined, "sample", "logs")


# Each family: the columns z needs, then CRPS and log score in terms of p_<name>, y and z.
_CLOSED = {
    "normal": (
        "(y - p_mu) / p_sigma AS z",
        f"p_sigma * (z * (2 * {phi('z')} - 1) + 2 * {pdf('z')} - 1 / sqrt(pi()))",
        "z * z / 2 + ln(p_sigma * sqrt(2 * pi()))",
    ),
    "lognormal": (
        "CASE WHEN y > 0 THEN (ln(nullif(greatest(y, 0), 0)) - p_mu) / p_sigma END AS z, p_sigma / sqrt(2) AS w, "
        "CASE WHEN y > 0 THEN (ln(nullif(greatest(y, 0), 0)) - p_mu) / p_sigma - p_sigma END AS zs",
        f"y * (2 * CASE WHEN y > 0 THEN {phi('z')} ELSE 0 END - 1) - 2 * exp(p_mu + p_sigma * p_sigma / 2) * "
        f"(CASE WHEN y > 0 THEN {phi('zs')} ELSE 0 END + {phi('w')} - 1)",
        f"CASE WHEN y > 0 THEN -ln({pdf('z')} / (p_sigma * y)) ELSE 'inf'::DOUBLE END",
    ),
    "logistic": (
        "(y - p_location) / p_scale AS z",
        "p_scale * (z + 2 * ln(1 + exp(-z)) - 1)",
        "z + 2 * ln(1 + exp(-z)) + ln(p_scale)",
    ),
    "exponential": (
        "1 AS z",
        "CASE WHEN y >= 0 THEN y - 2 * (1 - exp(-p_rate * y)) / p_rate + 0.5 / p_rate ELSE -y + 0.5 / p_rate END",
        "CASE WHEN y >= 0 THEN p_rate * y - ln(p_rate) ELSE 'inf'::DOUBLE END",
    ),
    "uniform": (
        "(y - p_min) / (p_max - p_min) AS z",
        "(p_max - p_min) * (CASE WHEN z < 0 THEN -z + 1.0/3 WHEN z > 1 THEN z - 1 + 1.0/3 ELSE z * z - z + 1.0/3 END)",
        "CASE WHEN y < p_min OR y > p_max THEN 'inf'::DOUBLE ELSE ln(p_max - p_min) END",
    ),
    "bernoulli": (
        "1 AS z",
        "pow(p_prob - y, 2)",
        "-ln(CASE WHEN y = 1 THEN p_prob ELSE 1 - p_prob END)",
    ),
    # sums over the counts: CRPS is the integral of (F(k) - 1{y <= k})^2
    "poisson": (
        "1 AS z",
        "(SELECT sum(pow(cdf - CASE WHEN y <= k THEN 1 ELSE 0 END, 2)) FROM (SELECT k, "
        "sum(exp(k * ln(p_lambda) - p_lambda - lgamma(k + 1))) OVER (ORDER BY k) AS cdf FROM range(0, 800) r(k)) f)",
        "p_lambda + lgamma(y + 1) - y * ln(p_lambda)",
    ),
    # whole shapes make the distribution functions finite sums
    "gamma": (
        "p_rate * y AS z",
        "y * (2 * (1 - exp(-z) * list_sum(list_transform(range(0, p_shape::BIGINT), lambda k: pow(z, k) / gamma(k + 1)))) - 1)"
        " - p_shape / p_rate * (2 * (1 - exp(-z) * list_sum(list_transform(range(0, p_shape::BIGINT + 1), "
        "lambda k: pow(z, k) / gamma(k + 1)))) - 1) - gamma(p_shape + 0.5) / (gamma(0.5) * gamma(p_shape)) / p_rate",
        "CASE WHEN y > 0 THEN lgamma(p_shape) - p_shape * ln(p_rate) - (p_shape - 1) * ln(nullif(greatest(y, 0), 0)) "
        "+ p_rate * y ELSE 'inf'::DOUBLE END",
    ),
    "beta": (
        "(p_shape1 + p_shape2)::BIGINT AS z",
        "y * (2 * list_sum(list_transform(range(p_shape1::BIGINT, z), lambda j: gamma(z) / (gamma(j + 1) * gamma(z - j)) "
        "* pow(y, j) * pow(1 - y, z - 1 - j))) - 1) + p_shape1 / z * (1 - 2 * "
        "list_sum(list_transform(range(p_shape1::BIGINT + 1, z + 1), lambda j: gamma(z + 1) / (gamma(j + 1) * "
        "gamma(z + 1 - j)) * pow(y, j) * pow(1 - y, z - j))) - 2 * (gamma(2 * p_shape1) * gamma(2 * p_shape2) / "
        "gamma(2 * z)) / (p_shape1 * pow(gamma(p_shape1) * gamma(p_shape2) / gamma(z), 2)))",
        "ln(gamma(p_shape1) * gamma(p_shape2) / gamma(z)) - (p_shape1 - 1) * ln(y) - (p_shape2 - 1) * ln(1 - y)",
    ),
}


def _register_family(family: str) -> None:
    extra, crps, logs = _CLOSED[family]
    base = f"SELECT *, {extra} FROM ({wide('joined_parametric', family, FAMILY_PARAMETERS[family])}) w"
    for rule, text in (("crps", crps), ("logs", logs)):
        sql = f"SELECT {GROUP}, y AS observation, {text} AS {rule} FROM ({base}) b"

        @query(f"{rule}_{family}", "joined_parametric", sql, rule)
        def _(inp, family=family, rule=rule):
            return scoring.score_family(inp.joined_parametric, family, rule)


for _family in _CLOSED:
    _register_family(_family)


_PARAMETRIC_STATS = """
SELECT {group}, p_mu AS mean, p_mu AS median, p_sigma AS sd, p_mu + 1.959963984540054 * p_sigma AS quantile97_5,
       p_mu - 1.959963984540054 * p_sigma AS quantile02_5, p_mu + 1.6448536269514722 * p_sigma AS quantile90,
       p_mu - 1.6448536269514722 * p_sigma AS quantile10 FROM ({normal}) n
UNION ALL
SELECT {group}, exp(p_mu + p_sigma * p_sigma / 2), exp(p_mu),
       sqrt(exp(p_sigma * p_sigma) - 1) * exp(p_mu + p_sigma * p_sigma / 2), exp(p_mu + 1.959963984540054 * p_sigma),
       exp(p_mu - 1.959963984540054 * p_sigma), exp(p_mu + 1.6448536269514722 * p_sigma),
       exp(p_mu - 1.6448536269514722 * p_sigma) FROM ({lognormal}) l
UNION ALL
SELECT {group}, p_location, p_location, p_scale * pi() / sqrt(3), p_location + p_scale * ln(39),
       p_location - p_scale * ln(39), p_location + p_scale * ln(19), p_location - p_scale * ln(19) FROM ({logistic}) g
UNION ALL
SELECT {group}, 1 / p_rate, ln(2) / p_rate, 1 / p_rate, -ln(0.025) / p_rate, -ln(0.975) / p_rate, -ln(0.05) / p_rate,
       -ln(0.95) / p_rate FROM ({exponential}) e
UNION ALL
SELECT {group}, (p_min + p_max) / 2, (p_min + p_max) / 2, (p_max - p_min) / sqrt(12), p_min + 0.975 * (p_max - p_min),
       p_min + 0.025 * (p_max - p_min), p_min + 0.95 * (p_max - p_min), p_min + 0.05 * (p_max - p_min) FROM ({uniform}) u
UNION ALL
SELECT {group}, p_prob, CASE WHEN 0.5 <= 1 - p_prob THEN 0 ELSE 1 END, sqrt(p_prob * (1 - p_prob)),
       CASE WHEN 0.975 <= 1 - p_prob THEN 0 ELSE 1 END, CASE WHEN 0.025 <= 1 - p_prob THEN 0 ELSE 1 END,
       CASE WHEN 0.95 <= 1 - p_prob THEN 0 ELSE 1 END, CASE WHEN 0.05 <= 1 - p_prob THEN 0 ELSE 1 END
FROM ({bernoulli}) b""".format(
    group=GROUP, **{f: wide("joined_parametric", f, FAMILY_PARAMETERS[f]) for f in scoring.ARITHMETIC}
)


@query(
    "forecast_stats",
    "joined joined_parametric",
    sample_scores("joined", f"{GROUP}, {STATS}") + " UNION ALL " + _PARAMETRIC_STATS,
    STAT_NAMES,
)
def _(inp):
    rows = inp.joined.unionByName(inp.joined_parametric.where(F.col("family").isin(scoring.ARITHMETIC)))
    return scoring.summarize_forecast(rows.drop("observation")).select(*SCORE_GROUP, *STAT_NAMES.split())


@query("forecast_stats_iterative", "joined_parametric")
def _(inp):
    # quantiles of gamma, beta and Poisson forecasts are inverted numerically
    rows = inp.joined_parametric.where(F.col("family").isin("gamma", "beta", "poisson"))
    return scoring.summarize_forecast(rows.drop("observation"))


_ALL = f"{GROUP}, observation, crps, logs, {STATS}"
_JOINED_SCORES = sample_scores("joined", _ALL)


@query("score_joined", "joined", _JOINED_SCORES, f"crps logs {STAT_NAMES}")
def _(inp):
    return scoring.score_joined(inp.joined)


@query("score_joined_lean", "joined", sample_scores("joined", f"{GROUP}, observation, crps, logs"), "crps logs")
def _(inp):
    return scoring.score_joined(inp.joined, include_summaries=False)


@query("score_joined_ranked", "joined", _JOINED_SCORES, f"crps logs {STAT_NAMES}")
def _(inp):
    # runs of two members, so that every forecast is ranked across several
    return scoring.score_joined(inp.joined, run_bits=1)


@query(
    "score_union",
    "scores scores_old",
    "SELECT * FROM scores UNION SELECT * FROM scores_old",
)
def _(inp):
    return scoring.score_union(inp.scores, inp.scores_old)


_REVISED = "SELECT * REPLACE (crps + 1 AS crps) FROM scores WHERE datetime >= TIMESTAMP '2024-01-10 00:00:00'"


@query(
    "score_upsert",
    "scores scores_old",
    f"""SELECT * FROM scores_old WHERE datetime < TIMESTAMP '2024-01-10 00:00:00' UNION ALL {_REVISED}""",
)
def _(inp):
    new = inp.scores.where(F.col("datetime") >= ntz(F.lit("2024-01-10 00:00:00"))).withColumn("crps", F.col("crps") + 1)
    return scoring.score_upsert(inp.scores_old, new)


@query(
    "score_upsert_write",
    "scores scores_old",
    f"""SELECT * FROM scores_old WHERE datetime < TIMESTAMP '2024-01-10 00:00:00' UNION ALL {_REVISED}""",
)
def _(inp):
    # the score table on disk; the delivery comes twice (a replay), and only its partitions are rewritten
    new = inp.scores.where(F.col("datetime") >= ntz(F.lit("2024-01-10 00:00:00"))).withColumn("crps", F.col("crps") + 1)
    folder = f"{shared_folder(inp.spark, 'score-table')}/parquet"
    tables.write_bundle(inp.scores_old, folder)
    for _ in range(2):
        tables.merge_partitions(new, folder, BUNDLE_PARTITIONS, lambda rows, old: scoring.score_upsert(old, rows))
    return tables.read_dataset(inp.spark, folder, new.schema)


@query(
    "score_checks",
    "scores",
    """SELECT count(*) AS n_rows, count(DISTINCT concat(duration, '|', variable, '|', model_id)) AS n_groups,
              min(reference_datetime) AS first_fc, max(reference_datetime) AS last_fc,
              min(datetime) AS first_prediction, max(datetime) AS last_prediction FROM scores""",
)
def _(inp):
    return scoring.score_checks(inp.scores)


_BOARD = """SELECT variable, model_id, avg(crps) AS crps FROM ({scores}) s
 WHERE date_diff('microsecond', reference_datetime, datetime) / 86400e6 > 0
   AND date_diff('microsecond', reference_datetime, datetime) / 86400e6 < 35
 GROUP BY variable, model_id"""


@query(
    "score_to_leaderboard",
    "forecasts scores_old",
    _BOARD.format(scores=sample_scores(f"({_CANDIDATES}) c", f"{GROUP}, crps")),
    "crps",
)
def _(inp):
    """The flagship: eligible and unscored forecasts, scored and ranked in one plan."""
    scores = scoring.score_joined(_candidates(inp), include_summaries=False)
    return boards.leaderboard(scores, ["variable", "model_id"])
