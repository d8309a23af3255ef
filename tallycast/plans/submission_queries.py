"""Queries on submissions and their storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallycast.functions.timing import ntz
from tallycast.operators import scoring
from tallycast.operators import submissions as ops
from tallycast.plans.registry import query
from tallycast.plans.sqltext import GROUP, STATS, sample_scores
from tallycast.schema import BUNDLE_PARTITIONS, FORECAST_PARTITIONS, FORECASTS, STATS as STAT_COLUMNS
from tallycast.session import shared_folder
from tallycast.sources import tables

PUBLISHED = "2024-03-01 06:00:00"
_published = lambda: F.lit(PUBLISHED)

NAMES = """
names AS (
  SELECT *, string_split(file, '-')[1] AS theme,
         TRY_CAST(array_to_string(list_slice(string_split(file, '-'), 2, 4), '-') AS TIMESTAMP) AS file_reference,
         string_split(string_split(file, '-')[5], '.')[1] AS file_model,
         regexp_extract(file, '[.](csv[.]gz|[a-z]+)$', 1) AS extension
  FROM submissions)"""


@query(
    "parse_submission_name",
    "submissions",
    f"""WITH {NAMES} SELECT DISTINCT file, theme, file_reference, file_model, extension,
        extension IN ('csv', 'csv.gz', 'nc') AND file_reference IS NOT NULL AS accepted FROM names""",
)
def _(inp):
    return ops.parse_submission_name(inp.submissions.select("file").distinct())


@query(
    "allowed_combinations",
    "events",
    """SELECT 'group_a' AS target_group, v.variable, v.duration, CAST(v.max_horizon AS INTEGER) AS max_horizon, e.n
       FROM (VALUES ('view', 'P1D', 35), ('click', 'PT1H', 10)) v(variable, duration, max_horizon)
       JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) e ON e.event_type = v.variable
       UNION ALL SELECT 'group_b', v.variable, v.duration, CAST(v.max_horizon AS INTEGER), e.n
       FROM (VALUES ('error', 'P1W', 300)) v(variable, duration, max_horizon)
       JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) e ON e.event_type = v.variable""",
)
def _(inp):
    # the configuration's rows beside the number of events they permit
    groups = {
        "group_a": {"variable": ["view", "click"], "duration": ["P1D", "PT1H"], "max_horizon": [35, 10]},
        "group_b": {"variable": ["error"], "duration": ["P1W"], "max_horizon": [300]},
    }
    counts = inp.events.groupBy(F.col("event_type").alias("variable")).agg(F.count(F.lit(1)).alias("n"))
    return ops.allowed_combinations(inp.spark, groups).join(counts, "variable")


def _has(*names):
    return " AND ".join(f"list_contains(columns, '{n}')" for n in names)


_RULES = [
    ("extension", "extension IN ('csv', 'csv.gz')", True),
    ("single_model", "models = 1 AND NOT model_missing", True),
    ("has_variable_prediction", _has("variable", "prediction"), True),
    ("has_duration", _has("duration"), False),
    ("combination_allowed", "combinations", False),
    ("no_ensemble_column", "NOT " + _has("ensemble"), True),
    ("has_family_parameter", _has("family", "parameter"), True),
    ("single_family", "families = 1", True),
    ("member_limit", "members <= 500", True),
    ("has_site", _has("site_id"), False),
    ("has_project", _has("project_id"), False),
    ("datetime_readable", "times_read", True),
    ("has_reference", _has("reference_datetime"), True),
    ("horizon_allowed", "horizons", True),
]
_FILES = f"""
{NAMES},
typed AS (SELECT *, TRY_CAST(datetime AS TIMESTAMP) AS t, TRY_CAST(reference_datetime AS TIMESTAMP) AS r FROM names),
per_variable AS (
  SELECT p.file, coalesce(bool_or(a.max_horizon IS NOT NULL), false) AND max(p.durations) = 1 AS ok,
         max(lead) AS lead, coalesce(max(a.max_horizon), max(l.longest)) AS longest
  FROM (SELECT file, variable, min(duration) AS duration, count(DISTINCT duration) AS durations,
               max(date_diff('microsecond', r, t) / 86400e6) AS lead FROM typed GROUP BY file, variable) p
  LEFT JOIN allowed a ON a.variable = p.variable AND a.duration = p.duration
  LEFT JOIN (SELECT variable, max(max_horizon) AS longest FROM allowed GROUP BY variable) l ON l.variable = p.variable
  GROUP BY p.file, p.variable),
files AS (
  SELECT f.*, v.combinations, v.horizons FROM (
    SELECT file, min(extension) AS extension, count(DISTINCT model_id) AS models, bool_or(model_id IS NULL) AS model_missing,
           count(DISTINCT family) AS families,
           count(DISTINCT CASE WHEN family IN ('ensemble', 'sample') THEN parameter END) AS members,
           bool_and(t IS NOT NULL) AS times_read, any_value(columns) AS columns FROM typed GROUP BY file) f
  JOIN (SELECT file, bool_and(ok) AS combinations, bool_and(coalesce(lead <= longest, true)) AS horizons
        FROM per_variable GROUP BY file) v ON v.file = f.file),
judged AS (SELECT *, {' AND '.join(f'({text})' for _, text, fatal in _RULES if fatal)} AS valid FROM files)"""
_REPORT = f"WITH {_FILES} " + " UNION ALL ".join(
    f"SELECT file, '{name}' AS rule, {text} AS passed, {str(fatal).lower()} AS fatal, valid FROM judged"
    for name, text, fatal in _RULES
)


@query("validate_submissions", "submissions allowed", _REPORT)
def _(inp):
    return ops.validate_submissions(inp.submissions, inp.allowed)


_STANDARD = f"""
standard AS (
  SELECT 'demo' AS project_id, coalesce(nullif(model_id, 'null'), file_model) AS model_id, site_id,
         TRY_CAST(datetime AS TIMESTAMP) AS datetime,
         coalesce(TRY_CAST(reference_datetime AS TIMESTAMP), file_reference) AS reference_datetime,
         coalesce(duration, CASE theme WHEN 'aquatics' THEN 'P1D' WHEN 'ticks' THEN 'P1W' ELSE
           CASE WHEN datetime LIKE '%:%' THEN 'PT1H' ELSE 'P1D' END END) AS duration,
         variable, CASE WHEN family = 'ensemble' THEN 'sample' ELSE family END AS family, parameter,
         TRY_CAST(prediction AS DOUBLE) AS prediction, TIMESTAMP '{PUBLISHED}' AS pub_datetime
  FROM names)"""
_KEPT = """SELECT *, CAST(date_trunc('day', reference_datetime) AS TIMESTAMP) AS reference_date FROM standard
           WHERE datetime >= reference_datetime AND datetime <= reference_datetime + INTERVAL 35 DAY"""


def _standard(inp):
    return ops.standardize_forecast(inp.submissions, "demo", _published())


@query("standardize_forecast", "submissions", f"WITH {NAMES}, {_STANDARD} {_KEPT}")
def _(inp):
    return _standard(inp)


_REPEATED = "SELECT * FROM forecasts UNION ALL SELECT * REPLACE (prediction + 1 AS prediction) FROM forecasts WHERE model_id = 'm1'"


def _repeated(inp):
    again = inp.forecasts.where(F.col("model_id") == "m1").withColumn("prediction", F.col("prediction") + 1)
    return inp.forecasts.unionByName(again)


@query(
    "dedupe_mean",
    "forecasts",
    f"SELECT * EXCLUDE (prediction), avg(prediction) AS prediction FROM ({_REPEATED}) r GROUP BY ALL",
)
def _(inp):
    return ops.dedupe_mean(_repeated(inp))


@query(
    "summarize_forecast",
    "forecasts",
    sample_scores(
        f"(SELECT *, CAST(0 AS DOUBLE) AS observation FROM (SELECT * EXCLUDE (prediction), avg(prediction) AS prediction "
        f"FROM ({_REPEATED}) r GROUP BY ALL) a) b",
        f"{GROUP}, {STATS}",
    ),
    " ".join(STAT_COLUMNS),
)
def _(inp):
    return scoring.summarize_forecast(ops.dedupe_mean(_repeated(inp)))


@query(
    "write_forecasts",
    "submissions",
    f"""WITH {NAMES}, {_STANDARD} SELECT duration, variable, family, count(*) AS n, count(prediction) AS n_known,
        sum(prediction) AS total FROM ({_KEPT}) k GROUP BY duration, variable, family""",
    "total",
)
def _(inp):
    # written in the published layout, the first half twice (a replay), then read back
    rows = inp.submissions.where(F.col("datetime").isNotNull())
    stored = ops.standardize_forecast(rows, "demo", _published()).withColumn(
        "reference_date", F.col("reference_datetime").cast("date")
    )
    folder = shared_folder(inp.spark, "forecasts")
    tables.write_forecasts(stored, folder)
    tables.write_forecasts(stored.where(F.col("variable") <= "error"), folder)
    back = tables.read_dataset(inp.spark, folder, FORECASTS)
    return back.groupBy("duration", "variable", "family").agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("n_known"), F.sum("prediction").alias("total")
    )


_OLD = "SELECT * FROM forecasts WHERE datetime < TIMESTAMP '2024-01-20 00:00:00'"
_NEW = """SELECT * REPLACE (CASE WHEN parameter = '3' AND model_id = 'm1' THEN NULL ELSE prediction END AS prediction)
          FROM forecasts WHERE datetime > TIMESTAMP '2024-01-10 00:00:00'"""


def _deliveries(inp):
    at = lambda t: ntz(F.lit(t))
    old = inp.forecasts.where(F.col("datetime") < at("2024-01-20 00:00:00"))
    blank = (F.col("parameter") == "3") & (F.col("model_id") == "m1")
    new = inp.forecasts.where(F.col("datetime") > at("2024-01-10 00:00:00"))
    return new.withColumn("prediction", F.when(~blank, F.col("prediction"))), old


@query(
    "bundle_forecasts",
    "forecasts",
    f"""SELECT * FROM ({_OLD}) o UNION SELECT * FROM ({_NEW}) n
        WHERE model_id IS NOT NULL AND parameter IS NOT NULL AND prediction IS NOT NULL""",
)
def _(inp):
    return ops.bundle_forecasts(*_deliveries(inp))


@query(
    "bundle_write",
    "forecasts",
    f"""SELECT * FROM ({_OLD}) o UNION SELECT * FROM ({_NEW}) n
        WHERE model_id IS NOT NULL AND parameter IS NOT NULL AND prediction IS NOT NULL""",
)
def _(inp):
    # the bundle on disk, merged with a delivery twice (a replay)
    new, old = _deliveries(inp)
    folder = f"{shared_folder(inp.spark, 'bundle')}/parquet"
    tables.write_bundle(old, folder)
    complete = new.where(F.col("model_id").isNotNull())
    for _ in range(2):
        tables.merge_partitions(complete, folder, BUNDLE_PARTITIONS, ops.bundle_forecasts)
    return tables.read_dataset(inp.spark, folder, new.schema)


@query(
    "bundle_summaries",
    "scores scores_old",
    "SELECT * FROM scores_old UNION ALL SELECT * FROM scores WHERE datetime > TIMESTAMP '2024-01-14 00:00:00'",
)
def _(inp):
    return ops.bundle_summaries(
        inp.scores.where(F.col("datetime") > ntz(F.lit("2024-01-14 00:00:00"))), inp.scores_old
    )


@query(
    "bundle_summaries_write",
    "scores scores_old",
    "SELECT * FROM scores_old UNION ALL SELECT * FROM scores WHERE datetime > TIMESTAMP '2024-01-14 00:00:00'",
)
def _(inp):
    # the summaries on disk; the delivery has a name, so the second time it comes nothing is added
    folder = f"{shared_folder(inp.spark, 'summaries')}/parquet"
    tables.write_bundle(inp.scores_old, folder)
    new = inp.scores.where(F.col("datetime") > ntz(F.lit("2024-01-14 00:00:00")))
    for _ in range(2):
        tables.merge_partitions(new, folder, BUNDLE_PARTITIONS, ops.bundle_summaries, delivery="summaries-1")
    return tables.read_dataset(inp.spark, folder, new.schema)


def listed_store(inp, date: str, columns: list[str]):
    """Paths below ``store`` of the forecasts written by ``columns``, of which ``date`` is the day they were made."""
    folder = shared_folder(inp.spark, "store")
    tables.write_partitioned(inp.forecasts.withColumn(date, F.date_format("reference_datetime", "yyyy-MM-dd")), folder, columns)
    below = F.regexp_replace("path", "^.*?/project_id=", "store/project_id=")
    return tables.list_files(inp.spark, folder).select(below.alias("path"))


@query(
    "archive_inventory",
    "forecasts",
    """SELECT DISTINCT concat('store/project_id=', project_id, '/duration=', duration, '/variable=', variable, '/model_id=',
              model_id, '/') AS model_path FROM forecasts""",
)
def _(inp):
    return ops.archive_inventory(listed_store(inp, "reference_date", FORECAST_PARTITIONS))


@query(
    "most_recent_by_model",
    "forecasts",
    "SELECT model_id, variable, max(reference_datetime) AS most_recent FROM forecasts GROUP BY model_id, variable",
)
def _(inp):
    return ops.most_recent_by_model(inp.forecasts)


@query(
    "bundle_counts",
    "forecasts",
    "SELECT count(*) AS n_rows, max(reference_datetime) AS most_recent FROM forecasts",
)
def _(inp):
    return ops.bundle_counts(inp.forecasts)
