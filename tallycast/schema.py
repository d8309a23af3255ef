"""Table layouts and keys shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

OBS_KEY = ["project_id", "site_id", "datetime", "duration", "variable"]
SCORE_KEY = OBS_KEY + ["model_id", "family", "reference_datetime"]
SCORE_GROUP = SCORE_KEY + ["pub_datetime"]
SERIES_KEY = ["site_id", "variable"]
FORECAST_PARTITIONS = ["project_id", "duration", "variable", "model_id", "reference_date"]
BUNDLE_PARTITIONS = ["project_id", "duration", "variable", "model_id"]

STATS = ["mean", "median", "sd", "quantile97_5", "quantile02_5", "quantile90", "quantile10"]
SCORE_VALUES = ["observation", "crps", "logs", *STATS]

_NTZ = T.TimestampNTZType()


def _fields(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in cols.items()])


TARGETS = _fields(
    project_id=T.StringType(),
    site_id=T.StringType(),
    datetime=_NTZ,
    duration=T.StringType(),
    variable=T.StringType(),
    observation=T.DoubleType(),
)

FORECASTS = _fields(
    project_id=T.StringType(),
    model_id=T.StringType(),
    site_id=T.StringType(),
    datetime=_NTZ,
    reference_datetime=_NTZ,
    duration=T.StringType(),
    variable=T.StringType(),
    family=T.StringType(),
    parameter=T.StringType(),
    prediction=T.DoubleType(),
    pub_datetime=_NTZ,
)

#: Submitted files are read as text and cast later, so that a bad value becomes a report row.
SUBMISSION_COLUMNS = [
    "project_id",
    "model_id",
    "datetime",
    "reference_datetime",
    "duration",
    "site_id",
    "family",
    "parameter",
    "variable",
    "prediction",
]
SUBMISSION = _fields(**{c: T.StringType() for c in SUBMISSION_COLUMNS})

SITES = _fields(field_site_id=T.StringType(), latitude=T.DoubleType(), longitude=T.DoubleType())

# Forecast families and their parameter names.
FAMILY_PARAMETERS = {
    "normal": ["mu", "sigma"],
    "lognormal": ["mu", "sigma"],
    "logistic": ["location", "scale"],
    "exponential": ["rate"],
    "uniform": ["min", "max"],
    "bernoulli": ["prob"],
    "poisson": ["lambda"],
    "gamma": ["shape", "rate"],
    "beta": ["shape1", "shape2"],
}

# ISO-8601 durations in use, and their names.
DURATION_NAMES = {"P1D": "Daily", "PT1H": "Hourly", "PT30M": "30min", "P1W": "Weekly"}


def present(columns: list[str], df) -> list[str]:
    """The wanted columns the table really has, in the wanted order."""
    have = set(df.columns)
    return [c for c in columns if c in have]
