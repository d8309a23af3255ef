"""Queries on leaderboards and reporting tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallycast.functions.timing import day, ntz
from tallycast.operators import boards
from tallycast.plans.registry import query

TODAY = "2024-01-20"
_today = lambda: day(TODAY)
_at = lambda text: ntz(F.lit(text))

_LEAD = "date_diff('microsecond', reference_datetime, datetime) / 86400e6"
_SUMMARY = "model_id, site_id, datetime, reference_datetime, variable, mean, median, quantile97_5, quantile02_5, quantile90, quantile10"


def _summaries(inp):
    return inp.scores_durations.drop("observation", "crps", "logs")


@query(
    "latest_forecasts",
    "scores_durations sites",
    f"""SELECT s.duration, s.model_id, s.site_id, s.datetime, s.reference_datetime, s.variable, s.mean, s.median, s.quantile97_5,
               s.quantile02_5, s.quantile90, s.quantile10, p.latitude, p.longitude
        FROM scores_durations s JOIN (SELECT duration, variable, max(reference_datetime) AS r FROM scores_durations
                            WHERE reference_datetime < TIMESTAMP '{TODAY} 00:00:00' - INTERVAL 2 DAY GROUP BY duration, variable) n
             ON s.duration = n.duration AND s.variable = n.variable AND s.reference_datetime = n.r
        JOIN sites p ON p.field_site_id = s.site_id WHERE s.datetime > s.reference_datetime""",
)
def _(inp):
    return boards.latest_forecasts(_summaries(inp), inp.sites, _today())


_RECENT = "s.variable, model_id, site_id, datetime, reference_datetime, observation, mean, quantile02_5, quantile97_5"


@query(
    "recent_scores",
    "scores sites",
    f"""SELECT {_RECENT} FROM scores s JOIN sites p ON p.field_site_id = s.site_id
        WHERE reference_datetime > TIMESTAMP '2024-02-28 00:00:00' - INTERVAL 60 DAY
          AND reference_datetime < TIMESTAMP '2024-02-28 00:00:00' - INTERVAL 29 DAY""",
)
def _(inp):
    return boards.recent_scores(inp.scores, inp.sites, day("2024-02-28"), 60, 29)


@query(
    "recent_scores_weekly",
    "scores sites",
    f"""SELECT {_RECENT}, crps FROM scores s JOIN sites p ON p.field_site_id = s.site_id
        WHERE reference_datetime > TIMESTAMP '2024-12-20 00:00:00' - INTERVAL 365 DAY""",
)
def _(inp):
    return boards.recent_scores(inp.scores, inp.sites, day("2024-12-20"), 365)


def _board_sql(by: str, upper: str = "<") -> str:
    return f"""SELECT {by}, avg(crps) AS crps FROM (SELECT *, {_LEAD} AS horizon FROM scores_durations) s
               WHERE horizon > 0 AND horizon {upper} 35 GROUP BY {by}"""


@query("leaderboard_by_model", "scores_durations", _board_sql("duration, variable, model_id"), "crps")
def _(inp):
    return boards.leaderboard_by_model(inp.scores_durations)


@query("leaderboard_by_reference", "scores_durations", _board_sql("duration, variable, model_id, reference_datetime", "<="), "crps")
def _(inp):
    return boards.leaderboard_by_reference(inp.scores_durations)


@query("leaderboard_by_horizon", "scores_durations", _board_sql("duration, variable, model_id, horizon"), "crps")
def _(inp):
    return boards.leaderboard_by_horizon(inp.scores_durations)


@query(
    "horizon_filter",
    "scores",
    f"""SELECT variable, model_id, site_id, datetime, reference_datetime, {_LEAD} / 7.0 AS horizon FROM scores
        WHERE {_LEAD} / 7.0 > 0 AND {_LEAD} / 7.0 <= 4""",
    "horizon",
)
def _(inp):
    rows = boards.horizon_filter(inp.scores, 4, unit_days=7.0)
    return rows.select("variable", "model_id", "site_id", "datetime", "reference_datetime", "horizon")


@query(
    "leaderboard_weekly",
    "scores_durations",
    f"""WITH s AS (SELECT *, {_LEAD} AS horizon FROM scores_durations WHERE observation IS NOT NULL AND model_id NOT IN ('m2'))
        SELECT 'model' AS board, duration, variable, model_id, CAST(NULL AS TIMESTAMP) AS reference_datetime,
               CAST(NULL AS DOUBLE) AS horizon, avg(crps) AS crps
        FROM s WHERE horizon > 0 AND horizon < 35 GROUP BY duration, variable, model_id
        UNION ALL SELECT 'reference', duration, variable, model_id, reference_datetime, NULL, avg(crps)
        FROM s WHERE horizon > 0 AND horizon <= 35 GROUP BY duration, variable, model_id, reference_datetime
        UNION ALL SELECT 'horizon', duration, variable, model_id, NULL, horizon, avg(crps)
        FROM s WHERE horizon > 0 AND horizon < 35 GROUP BY duration, variable, model_id, horizon""",
    "crps",
)
def _(inp):
    return boards.leaderboard_weekly(inp.scores_durations, ["m2"])


@query(
    "board_filter",
    "scores",
    """SELECT * FROM scores WHERE variable = 'click' AND site_id IN ('S000001', 'S000002', 'S000003', 'S000005')
       AND model_id NOT IN ('m0') AND datetime <= TIMESTAMP '2024-01-25 00:00:00'""",
)
def _(inp):
    sites = ["S000001", "S000002", "S000003", "S000005"]
    return boards.board_filter(inp.scores, "click", sites, ["m0"], _at("2024-01-25 00:00:00"))


@query(
    "model_order",
    "scores",
    """SELECT model_id, median_crps, CAST(dense_rank() OVER (ORDER BY median_crps DESC) AS INTEGER) AS position
       FROM (SELECT model_id, quantile_cont(crps, 0.5) AS median_crps FROM scores GROUP BY model_id) m""",
    "median_crps",
)
def _(inp):
    return boards.model_order(inp.scores)


_HOLES = "SELECT * REPLACE (CASE WHEN model_id = 'm1' THEN NULL ELSE crps END AS crps) FROM scores"


@query(
    "missing_scores",
    "scores",
    f"""SELECT variable, model_id, count(*) AS n FROM ({_HOLES}) s GROUP BY variable, model_id
        HAVING count(crps) = 0""",
)
def _(inp):
    holes = inp.scores.withColumn("crps", F.when(F.col("model_id") != "m1", F.col("crps")))
    return boards.missing_scores(holes, ["variable", "model_id"])


@query("missing_score_guard", "scores", "SELECT * FROM scores")
def _(inp):
    # the guard lets a complete table pass; that it stops others is tested by itself
    return boards.missing_score_guard(inp.scores)


@query(
    "earliest_reference",
    "scores",
    "SELECT * FROM scores WHERE reference_datetime = (SELECT min(reference_datetime) FROM scores)",
)
def _(inp):
    return boards.earliest_reference(inp.scores)


@query(
    "class_leaderboard",
    "scores",
    """SELECT model_id, avg(crps) AS crps FROM scores WHERE model_id IN ('m0', 'm2')
       AND reference_datetime >= TIMESTAMP '2024-01-05 00:00:00' AND site_id = 'S000003' GROUP BY model_id ORDER BY crps""",
    "crps",
)
def _(inp):
    return boards.class_leaderboard(inp.scores, ["m0", "m2"], _at("2024-01-05 00:00:00"), "S000003")


@query(
    "submission_stats",
    "forecasts",
    """SELECT CAST(count(*) AS BIGINT) AS n_submissions, count(DISTINCT model_id) AS n_models
       FROM (SELECT DISTINCT model_id, variable, duration, reference_datetime FROM forecasts) f""",
)
def _(inp):
    return boards.submission_stats(inp.forecasts)


@query(
    "submissions",
    "forecasts",
    "SELECT DISTINCT model_id, variable, duration, reference_datetime FROM forecasts",
)
def _(inp):
    return boards.submissions(inp.forecasts)


@query(
    "target_extent",
    "targets",
    """SELECT min(datetime) AS first, max(datetime) AS last, count(DISTINCT variable) AS n_variables,
              date_diff('day', min(datetime), max(datetime)) / 365.25 AS years
       FROM targets WHERE observation IS NOT NULL""",
    "years",
)
def _(inp):
    return boards.target_extent(inp.targets)


@query(
    "variable_table",
    "targets allowed",
    """SELECT t.variable, t.duration, a.max_horizon FROM (SELECT DISTINCT variable, duration FROM targets) t
       LEFT JOIN allowed a ON t.variable = a.variable AND t.duration = a.duration""",
)
def _(inp):
    return boards.variable_table(inp.targets, inp.allowed)


#: Not all sites are registered.
_REGISTERED = "SELECT field_site_id FROM sites WHERE latitude < 50"
_REPORTED = f"duration IN ('P1D', 'P1W') AND site_id IN ({_REGISTERED})"


def _registered(inp):
    return inp.sites.where(F.col("latitude") < 50)


@query(
    "submissions_per_month",
    "scores sites",
    f"""SELECT CAST(date_trunc('month', reference_datetime) AS TIMESTAMP) AS month, count(*) AS n
       FROM (SELECT DISTINCT model_id, variable, duration, reference_datetime, site_id FROM scores WHERE {_REPORTED}) f
       WHERE reference_datetime >= TIMESTAMP '2023-12-01 00:00:00'
         AND reference_datetime < TIMESTAMP '2025-02-01 00:00:00' GROUP BY 1""",
)
def _(inp):
    return boards.submissions_per_month(inp.scores, _registered(inp), _at("2023-12-01 00:00:00"), _at("2025-02-01 00:00:00"))


_COUNT_SUBMISSIONS = "count(DISTINCT (model_id, reference_datetime, variable, duration, site_id))"
_COUNT_PAIRS = "count(DISTINCT (model_id, reference_datetime, variable, duration, site_id, datetime))"


def _counts_sql() -> str:
    parts = []
    for kind, text in (
        ("submissions", _COUNT_SUBMISSIONS),
        ("pairs", _COUNT_PAIRS),
        ("models", "count(DISTINCT model_id)"),
    ):
        month = f"{text} / 48.0" if kind == "submissions" else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT variable, '{kind}' AS kind, {text} AS n, CASE WHEN variable = 'view' THEN 'weekly' ELSE 'daily' "
            f"END AS frequency, CAST(NULL AS DOUBLE) AS per_month FROM s GROUP BY variable"
        )
        every = "every" if kind == "models" else "s"
        parts.append(f"SELECT 'all', '{kind}', {text}, CAST(NULL AS VARCHAR), {month} FROM {every}")
    inputs = f"every AS (SELECT * FROM scores WHERE {_REPORTED}), s AS (SELECT * FROM every WHERE variable <> 'signup')"
    return f"WITH {inputs} " + " UNION ALL ".join(parts)


@query("submission_counts", "scores sites", _counts_sql(), "per_month")
def _(inp):
    return boards.submission_counts(inp.scores, _registered(inp), ["view"], 48, ["signup"], inp.tasks("scores"))


@query(
    "total_rows",
    "targets scores forecasts sites",
    f"""WITH c AS (
         SELECT 'targets' AS kind, count(*) AS n FROM targets
         WHERE datetime < TIMESTAMP '2024-01-25 00:00:00' AND observation IS NOT NULL AND {_REPORTED}
         UNION ALL SELECT 'scored', count(*) FROM (SELECT DISTINCT reference_datetime, model_id, variable, duration,
           datetime, site_id FROM scores WHERE {_REPORTED}
           AND reference_datetime >= TIMESTAMP '2023-12-15 00:00:00'
           AND reference_datetime < TIMESTAMP '2025-02-01 00:00:00') a
         UNION ALL SELECT 'members', count(*) FROM (SELECT DISTINCT reference_datetime, model_id, variable, duration,
           datetime, site_id, parameter FROM forecasts WHERE {_REPORTED}
           AND reference_datetime >= TIMESTAMP '2023-12-15 00:00:00'
           AND reference_datetime < TIMESTAMP '2025-02-01 00:00:00') b)
       SELECT kind, n FROM c UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM c""",
)
def _(inp):
    return boards.total_rows(
        inp.targets,
        inp.scores,
        inp.forecasts,
        _registered(inp),
        _at("2024-01-25 00:00:00"),
        _at("2023-12-15 00:00:00"),
        _at("2025-02-01 00:00:00"),
    )


_OBS = ["project_id", "site_id", "datetime", "duration", "variable"]
_OBS_JOIN = " AND ".join(f"f.{k} = t.{k}" for k in _OBS)


@query(
    "trajectory_vs_obs",
    "forecasts targets",
    f"""SELECT f.*, t.observation FROM forecasts f LEFT JOIN targets t ON {_OBS_JOIN}
        WHERE f.reference_datetime = TIMESTAMP '2024-01-09 00:00:00' AND f.site_id = 'S000003'
          AND TRY_CAST(f.parameter AS INTEGER) < 150""",
)
def _(inp):
    return boards.trajectory(inp.forecasts, inp.targets, _at("2024-01-09 00:00:00"), "S000003")


@query(
    "lead_times",
    "forecasts targets",
    f"""SELECT f.*, {_LEAD.replace('reference', 'f.reference').replace(', datetime', ', f.datetime')} AS horizon,
               t.observation
        FROM forecasts f LEFT JOIN targets t ON {_OBS_JOIN}
        WHERE f.datetime = TIMESTAMP '2024-01-10 00:00:00' AND f.site_id = 'S000003'
          AND TRY_CAST(f.parameter AS INTEGER) < 150""",
    "horizon",
)
def _(inp):
    return boards.lead_times(inp.forecasts, inp.targets, _at("2024-01-10 00:00:00"), "S000003")


@query(
    "latest_by_site",
    "scores",
    """SELECT s.* FROM scores s JOIN (SELECT model_id, site_id, max(reference_datetime) AS r FROM scores
       GROUP BY model_id, site_id) n ON s.model_id = n.model_id AND s.site_id = n.site_id AND s.reference_datetime = n.r""",
)
def _(inp):
    return boards.latest_by_site(inp.scores)


@query(
    "latest_full_horizon",
    "scores",
    """SELECT model_id, site_id, reference_datetime, CAST(max_horizon AS INTEGER) AS max_horizon FROM (
         SELECT *, row_number() OVER (PARTITION BY model_id, site_id ORDER BY max_horizon DESC, reference_datetime DESC) i
         FROM (SELECT model_id, site_id, reference_datetime,
                      date_diff('day', reference_datetime, max(datetime)) AS max_horizon FROM scores
               WHERE reference_datetime < TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 30 DAY
               GROUP BY model_id, site_id, reference_datetime) a) b WHERE i = 1""",
)
def _(inp):
    return boards.latest_full_horizon(inp.scores, day("2024-02-10"))


@query(
    "score_vs_baseline",
    "scores",
    """SELECT b.site_id, b.reference_datetime, b.datetime, b.variable, m.model_id, m.crps, b.crps AS clim_crps,
              1 - m.crps / nullif(b.crps, 0) AS skill
       FROM (SELECT * FROM scores WHERE model_id = 'm2' AND datetime > TIMESTAMP '2024-01-04 00:00:00') m
       RIGHT JOIN (SELECT * FROM scores WHERE model_id = 'm0') b ON m.site_id = b.site_id
         AND m.reference_datetime = b.reference_datetime AND m.datetime = b.datetime AND m.variable = b.variable""",
    "skill",
)
def _(inp):
    model = inp.scores.where((F.col("model_id") == "m2") & (F.col("datetime") > _at("2024-01-04 00:00:00")))
    return boards.score_vs_baseline(model, inp.scores.where(F.col("model_id") == "m0"))
