"""From submitted files to stored forecasts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast.functions.timing import horizon_days_exact, ntz
from tallycast.operators.scoring import MAX_HORIZON_DAYS, sample_family
from tallycast.schema import SUBMISSION_COLUMNS, present

# Accepted file endings, and the duration implied by a theme.
EXTENSIONS = ["csv", "csv.gz", "nc"]
VALID_EXTENSIONS = ["csv", "csv.gz"]
THEME_DURATIONS = {
    "terrestrial_30min": "PT30M",
    "ticks": "P1W",
    "beetles": "P1W",
    "aquatics": "P1D",
    "phenology": "P1D",
    "terrestrial_daily": "P1D",
}
MAX_MEMBERS = 500
#: Rules that only warn unless validation is strict.
WARNINGS = ["combination_allowed", "has_site", "has_project", "has_duration"]


def parse_submission_name(files: DataFrame, column: str = "file", foreign: list[str] | None = None) -> DataFrame:
    """Theme, issue date, model and extension from ``theme-YYYY-MM-DD-model.ext``; NULL date if unreadable.

    The model is the fifth part of the name, so a hyphen in a model name cuts it. ``foreign`` lists themes of other
    projects. ``accepted`` says whether the name can be processed.
    """
    name = F.regexp_replace(F.element_at(F.split(F.col(column), "/"), -1), "'", "")
    part = F.split(name, "-")
    stem = F.split(F.regexp_replace(name, r"(\.[A-Za-z0-9]+){1,2}$", ""), "-")
    date = F.concat_ws("-", F.get(part, F.lit(1)), F.get(part, F.lit(2)), F.get(part, F.lit(3)))
    rows = files.withColumns(
        {
            "theme": F.get(part, F.lit(0)),
            "file_reference": ntz(F.try_to_date(date, "yyyy-MM-dd")),
            "file_model": F.get(stem, F.lit(4)),
            "extension": F.regexp_extract(name, r"\.((?:csv\.gz)|[A-Za-z0-9]+)$", 1),
        }
    )
    ok = F.col("extension").isin(EXTENSIONS) & F.col("file_reference").isNotNull() & F.col("file_model").isNotNull()
    if foreign:
        ok = ok & ~F.col("theme").isin(foreign)
    return rows.withColumn("accepted", F.coalesce(ok, F.lit(False)))


def allowed_combinations(spark: SparkSession, groups: Mapping[str, Mapping[str, list]]) -> DataFrame:
    """Permitted (group, variable, duration, max_horizon) rows from configuration's parallel lists."""
    schema = T.StructType(
        [
            T.StructField("target_group", T.StringType()),
            T.StructField("variable", T.ArrayType(T.StringType())),
            T.StructField("duration", T.ArrayType(T.StringType())),
            T.StructField("max_horizon", T.ArrayType(T.IntegerType())),
        ]
    )
    rows = [(g, c["variable"], c["duration"], c["max_horizon"]) for g, c in groups.items()]
    zipped = F.explode(F.arrays_zip("variable", "duration", "max_horizon"))
    return spark.createDataFrame(rows, schema).select("target_group", zipped.alias("c")).select("target_group", "c.*")


_TIME = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def _time(column: str) -> Column:
    """A submitted time: a date, with or without time of day, seconds, fraction and zone; NULL if unreadable."""
    text = F.trim(F.col(column))
    return F.when(text.rlike(_TIME), F.try_to_timestamp(text)).cast("timestamp_ntz")


def validate_submissions(rows: DataFrame, allowed: DataFrame, strict: bool = False) -> DataFrame:
    """One report row per (file, rule): ``passed``, ``fatal``, and whether the whole file is ``valid``.

    Files may differ in their columns: where the rows have ``columns``, it says what their file has, otherwise all files
    have the columns of the table. Rows are aggregated per (file, variable), then per file: more than one distinct value shows as min <> max, and
    members are made distinct as rows before they are counted, so no task holds a file.
    """
    have = set(rows.columns)

    def col(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    missing = F.lit(False)
    at, issued = _time("datetime") if "datetime" in have else F.lit(None), _time("reference_datetime") if (
        "reference_datetime" in have
    ) else F.lit(None)
    typed = rows.select(
        "file",
        *[col(c).alias(c) for c in SUBMISSION_COLUMNS],
        (F.col("columns") if "columns" in have else F.array(*map(F.lit, sorted(have)))).alias("_columns"),
        at.cast("timestamp_ntz").alias("_at"),
        issued.cast("timestamp_ntz").alias("_issued"),
    )
    typed = typed.withColumn("_lead", horizon_days_exact("_at", "_issued"))
    limits = allowed.groupBy("variable").agg(F.max("max_horizon").alias("_longest"))
    pairs = allowed.groupBy("variable", "duration").agg(F.max("max_horizon").alias("_limit"), F.lit(True).alias("_allowed"))

    member = F.when(F.col("family").isin("ensemble", "sample"), F.col("parameter"))
    members = typed.select("file", member.alias("parameter")).where(F.col("parameter").isNotNull()).distinct()
    members = members.groupBy("file").agg(F.count(F.lit(1)).alias("_members"))

    per_variable = typed.groupBy("file", "variable").agg(
        F.min("duration").alias("duration"),
        (F.min("duration") == F.max("duration")).alias("_one_duration"),
        F.max("_lead").alias("_lead"),
        F.min("model_id").alias("_model_a"),
        F.max("model_id").alias("_model_b"),
        F.bool_and(F.col("model_id").isNotNull()).alias("_model_known"),
        F.min("family").alias("_family_a"),
        F.max("family").alias("_family_b"),
        F.bool_and(F.col("family").isNotNull()).alias("_family_known"),
        F.bool_and(F.col("_at").isNotNull() & F.col("datetime").contains("-")).alias("_times_read"),
        F.max("_columns").alias("_columns"),
    )
    per_variable = per_variable.join(pairs, ["variable", "duration"], "left").join(limits, "variable", "left")
    per_file = per_variable.groupBy("file").agg(
        F.bool_and(F.coalesce(F.col("_allowed") & F.col("_one_duration"), missing)).alias("combination_allowed"),
        F.bool_and(F.coalesce(F.col("_lead") <= F.coalesce("_limit", "_longest"), F.lit(True))).alias("horizon_allowed"),
        (F.bool_and("_model_known") & (F.min("_model_a") == F.max("_model_b"))).alias("single_model"),
        (F.bool_and("_family_known") & (F.min("_family_a") == F.max("_family_b"))).alias("single_family"),
        F.bool_and("_times_read").alias("datetime_readable"),
        F.max("_columns").alias("_columns"),
    )
    checked = parse_submission_name(per_file.join(members, "file", "left"))

    def has(*names: str) -> Column:
        return F.array_size(F.array_intersect("_columns", F.array(*map(F.lit, names)))) == len(names)

    rules: dict[str, Column] = {
        "extension": F.col("extension").isin(VALID_EXTENSIONS),
        "single_model": F.col("single_model") | ~has("model_id"),
        "has_variable_prediction": has("variable", "prediction"),
        "has_duration": has("duration"),
        "combination_allowed": F.col("combination_allowed"),
        "no_ensemble_column": ~has("ensemble"),
        "has_family_parameter": has("family", "parameter"),
        "single_family": F.col("single_family"),
        "member_limit": F.coalesce(F.col("_members") <= MAX_MEMBERS, F.lit(True)),
        "has_site": has("site_id"),
        "has_project": has("project_id"),
        "datetime_readable": F.col("datetime_readable"),
        "has_reference": has("reference_datetime") | has("start_time"),
        "horizon_allowed": F.col("horizon_allowed"),
    }
    soft = [] if strict else WARNINGS
    passed = {n: F.coalesce(c.cast("boolean"), missing) for n, c in rules.items()}
    valid = F.lit(True)
    for name, ok in passed.items():
        if name not in soft:
            valid = valid & ok
    report = F.array(
        *[
            F.struct(F.lit(n).alias("rule"), ok.alias("passed"), F.lit(n not in soft).alias("fatal"))
            for n, ok in passed.items()
        ]
    )
    rows = checked.select("file", valid.alias("valid"), F.explode(report).alias("r"))
    return rows.select("file", "r.rule", "r.passed", "r.fatal", "valid")


def valid_files(report: DataFrame) -> DataFrame:
    return report.where("valid").select("file").distinct()


def standardize_forecast(rows: DataFrame, project: str, published: Column) -> DataFrame:
    """Submitted text rows of valid files as typed forecast rows, blanks filled from the file name."""
    named = parse_submission_name(rows)
    themed = F.lit(None).cast("string")
    for theme, duration in THEME_DURATIONS.items():
        themed = F.when(F.col("theme") == theme, F.lit(duration)).otherwise(themed)
    implied = F.coalesce(themed, F.when(F.col("datetime").contains(":"), F.lit("PT1H")).otherwise(F.lit("P1D")))
    duration = F.coalesce("duration", implied)
    model = F.when(F.col("model_id") == "null", None).otherwise(F.col("model_id"))
    typed = named.select(
        F.lit(project).alias("project_id"),
        F.coalesce(model, "file_model").alias("model_id"),
        "site_id",
        _time("datetime").alias("datetime"),
        F.coalesce(_time("reference_datetime"), "file_reference").alias("reference_datetime"),
        F.when(duration == "PT30", F.lit("PT30M")).otherwise(duration).alias("duration"),
        "variable",
        sample_family().alias("family"),
        "parameter",
        F.expr("try_cast(prediction AS DOUBLE)").alias("prediction"),
        ntz(published).alias("pub_datetime"),
    )
    lead = horizon_days_exact()
    return typed.where((lead >= 0) & (lead <= MAX_HORIZON_DAYS)).withColumn(
        "reference_date", F.to_date("reference_datetime")
    )


DEDUPE_KEY = [
    "site_id",
    "datetime",
    "reference_datetime",
    "family",
    "duration",
    "model_id",
    "parameter",
    "pub_datetime",
    "reference_date",
    "variable",
    "project_id",
]


def dedupe_mean(forecasts: DataFrame) -> DataFrame:
    """One prediction per member: the mean over repeated rows."""
    return forecasts.groupBy(*present(DEDUPE_KEY, forecasts)).agg(F.avg("prediction").alias("prediction"))


def bundle_forecasts(new: DataFrame, bundle: DataFrame) -> DataFrame:
    """Complete new rows joined to the bundle without exact repeats, all models in one pass."""
    complete = new.where(
        F.col("model_id").isNotNull() & F.col("parameter").isNotNull() & F.col("prediction").isNotNull()
    )
    return bundle.unionByName(complete.select(*bundle.columns)).distinct()


def bundle_summaries(new: DataFrame, bundle: DataFrame) -> DataFrame:
    return bundle.unionByName(new.select(*bundle.columns))


def archive_inventory(paths: DataFrame, column: str = "path") -> DataFrame:
    """Distinct model folders that hold data files."""
    folder = F.regexp_replace(F.col(column), r"reference_date=[^/]*/[^/]*$", "")
    return paths.select(folder.alias("model_path")).distinct()


def most_recent_by_model(bundle: DataFrame) -> DataFrame:
    newest = bundle.groupBy("model_id", "variable").agg(F.max("reference_datetime").alias("most_recent"))
    return newest.orderBy(F.desc("most_recent"), "model_id", "variable")


def bundle_counts(bundle: DataFrame) -> DataFrame:
    return bundle.agg(F.count(F.lit(1)).alias("n_rows"), F.max("reference_datetime").alias("most_recent"))
