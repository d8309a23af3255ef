"""Inventory tables behind a data catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.operators.ranks import keep_extreme
from tallycast.schema import DURATION_NAMES

CATALOG_DURATIONS = ["P1D", "P1W"]


def model_sites(df: DataFrame, sites: DataFrame, durations: list[str] | None = None) -> DataFrame:
    """Which model forecasts which variable at which registered site."""
    rows = df.where(F.col("model_id").isNotNull() & F.col("duration").isin(durations or CATALOG_DURATIONS))
    at = sites.select(F.col("field_site_id").alias("site_id"))
    return rows.select("model_id", "variable", "duration", "site_id").distinct().join(at, "site_id", "left_semi")


def model_extents(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """First and last valid, issue and publication times of each model's variables, in one pass."""
    by = keys or ["variable", "duration", "model_id"]
    out = []
    for column, name in (("datetime", "date"), ("reference_datetime", "reference"), ("pub_datetime", "pub")):
        out += [F.min(column).alias(f"{name}_min"), F.max(column).alias(f"{name}_max")]
    return df.groupBy(*by).agg(*out)


def registered_models(registry: DataFrame) -> DataFrame:
    """The fullest registration of each model in each project."""
    rest = [c for c in registry.columns if c not in ("model_id", "project_id")]
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in rest])
    return keep_extreme(registry, ["model_id", "project_id"], [filled])


def duration_name(column: str = "duration") -> Column:
    name = F.col(column)
    for iso, label in DURATION_NAMES.items():
        name = F.when(F.col(column) == iso, F.lit(label)).otherwise(name)
    return name


def catalog_items(
    df: DataFrame, sites: DataFrame, registry: DataFrame, names: DataFrame, durations: list[str] | None = None
) -> DataFrame:
    """One row per registered model, variable and duration with everything a catalog entry states.

    Models that are not registered, and examples, are left out.
    """
    known = registered_models(registry).select("model_id", "long_name")
    known = known.where(~F.col("model_id").contains("example"))
    keys = ["variable", "duration", "model_id"]
    at = model_sites(df, sites, durations).groupBy(*keys).agg(F.array_sort(F.collect_set("site_id")).alias("sites"))
    rows = model_extents(df).join(known, "model_id").join(at, keys, "left")
    rows = rows.join(names.select("variable", "target_group", "full_name"), "variable", "left")
    label = F.concat_ws(" ", duration_name(), F.coalesce("full_name", "variable"))
    return rows.select(
        "target_group",
        *keys,
        "long_name",
        "date_min",
        "date_max",
        F.coalesce("pub_max", "reference_max").alias("published"),
        duration_name().alias("duration_name"),
        label.alias("variable_name"),
        F.concat_ws("_", duration_name(), F.coalesce("full_name", "variable")).alias("item_title"),
        F.coalesce(F.size("sites"), F.lit(0)).alias("n_sites"),
        F.array_join("sites", ", ").alias("site_list"),
    )


def as_json(df: DataFrame, keys: list[str], name: str = "document") -> DataFrame:
    """Every row as a JSON document beside its keys."""
    return df.select(*keys, F.to_json(F.struct(*df.columns)).alias(name))


def group_extents(df: DataFrame, names: DataFrame) -> DataFrame:
    """Time range and number of sites of each group of variables.

    Sites are made distinct as rows, not gathered.
    """
    rows = df.join(names.select("variable", "target_group"), "variable")
    per_site = rows.groupBy("target_group", "site_id").agg(F.min("datetime").alias("a"), F.max("datetime").alias("b"))
    return per_site.groupBy("target_group").agg(
        F.min("a").alias("first"), F.max("b").alias("last"), F.count("site_id").alias("n_sites")
    )


def path_inventory(paths: DataFrame, column: str = "path") -> DataFrame:
    """The named segments of a partitioned path."""

    def segment(name: str) -> Column:
        found = F.regexp_extract(column, rf"{name}=([^/]*)", 1)
        return F.when(found != "", found).alias(name)

    names = ["project_id", "duration", "variable", "model_id", "reference_datetime", "date"]
    return paths.select(*[segment(n) for n in names]).distinct()


def site_features(sites: DataFrame) -> DataFrame:
    """Sites as geographic features."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"), F.array(F.col("longitude"), F.col("latitude")).alias("coordinates")
        ).alias("geometry"),
        F.struct(F.trim("field_site_id").alias("site_id")).alias("properties"),
    )
    return sites.select(F.trim("field_site_id").alias("site_id"), F.to_json(feature).alias("feature"))


def column_descriptions(spark: SparkSession, table: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Name, type and description of a table's columns."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(table.schema.fields)]
    columns = spark.createDataFrame(rows, "position int, name string, type string")
    return columns.join(dictionary, "name", "left")


def target_date_range(targets: DataFrame) -> DataFrame:
    return targets.agg(F.min("datetime").alias("first"), F.max("datetime").alias("last"))


# Registration answers.
YES, NO = "Yes", "No"
FROM_DATA = {
    "initial_conditions": "Yes and they were estimated from data",
    "process": "Yes and the uncertainty was estimated from data",
    "noise": "Yes and the noise was estimated from data",
    "random_effects": "Yes and the uncertainty was estimated from data",
}
NOT_FROM_DATA = {
    "initial_conditions": "Yes and they were not estimated from data",
    "process": "Yes and the uncertainty was not estimated from data",
    "noise": "Yes and the noise was not estimated from data",
    "random_effects": "Yes and the uncertainty was not estimated from data",
}
PARAMETERS_NOT_FROM_DATA = "Yes and they are not estimated from data"
PARAMETERS_FROM_DATA = "Yes and at least one is estimated from data"
UPDATES_STATE = ["Initial conditions", "Both initial conditions and parameters"]
UPDATES_PARAMETERS = ["Parameter", "Both initial conditions and parameters"]
PROPAGATION = "Infer from family column in archived forecasts"
UNKNOWN = "Unknown"


def _is(column: str, *answers: str) -> Column:
    return F.coalesce(F.col(column).isin(list(answers)), F.lit(False))


def _starts(column: str, answer: str) -> Column:
    return F.coalesce(F.col(column).startswith(answer), F.lit(False))


def uncertainty_profile(registry: DataFrame) -> DataFrame:
    """Per model and source of uncertainty: present, data driven, propagated, assimilated.

    ``present`` is true, false or Unknown as text. Registrations without a model type are Unknown throughout and have
    no entry for parameters.
    """
    true, false, unknown = F.lit("true"), F.lit("false"), F.lit(UNKNOWN)
    yes_no = F.lit(True), F.lit(False)
    rows = registry.where(F.col("model_id").isNotNull())

    def entry(source: str, present: Column, driven: Column, propagated: Column, assimilation: Column | None = None):
        method = F.lit(None).cast("string") if assimilation is None else assimilation
        described = F.col("model_type").isNotNull()
        return F.struct(
            F.lit(source).alias("source"),
            F.when(described, present).otherwise(unknown).alias("present"),
            F.when(described, driven).alias("data_driven"),
            F.when(described & propagated, F.lit(PROPAGATION)).alias("propagates"),
            F.when(described, method).alias("assimilation"),
        )

    def estimated(source: str, column: str) -> Column:
        """Answers that say both whether the uncertainty is there and where it comes from."""
        data = _is(column, YES, FROM_DATA[column])
        assumed = _starts(column, NOT_FROM_DATA[column])
        present = F.when(data | assumed, true).when(_is(column, NO), false).otherwise(unknown)
        return entry(source, present, F.when(data, yes_no[0]).when(assumed, yes_no[1]), data | assumed)

    ic = "initial_conditions"
    ic_data, ic_assumed, ic_none = _is(ic, YES, FROM_DATA[ic]), _starts(ic, NOT_FROM_DATA[ic]), _is(ic, NO)
    dynamic = _is("is_dynamic", YES)
    initial = entry(
        "initial_conditions",
        F.when(ic_data | ic_assumed | (ic_none & dynamic), true).when(ic_none, false).otherwise(unknown),
        F.when(ic_data, yes_no[0]).when(ic_assumed | (ic_none & dynamic), yes_no[1]),
        ic_data | ic_assumed,
        F.when(_is("assimilation", *UPDATES_STATE), F.col("assimilation_method")),
    )
    assumed = _is("parameters_used", YES, PARAMETERS_NOT_FROM_DATA)
    fitted = ~assumed & _is("parameters", YES, PARAMETERS_FROM_DATA)
    parameters = entry(
        "parameters",
        F.when(assumed | fitted, true),
        F.when(assumed, yes_no[1]).when(fitted, yes_no[0]),
        (assumed | fitted) & _is("parameters", YES),
        F.when(_is("assimilation", *UPDATES_PARAMETERS), F.col("assimilation_method")),
    )
    driven = _is("drivers", YES)
    used = _is("drivers", NO) & _is("uses_drivers", YES)
    drivers = entry(
        "drivers",
        F.when(driven | used, true).when(_is("drivers", NO), false).otherwise(unknown),
        F.when(driven | used, yes_no[0]),
        driven,
    )
    several = _is("structure", YES)
    structure = entry(
        "structural_error",
        F.when(several, true).when(_is("structure", NO), false).otherwise(unknown),
        F.when(several, yes_no[1]),
        several,
    )
    sources = [
        initial,
        parameters,
        drivers,
        estimated("process_error", "process"),
        estimated("obs_error", "noise"),
        structure,
        estimated("random_effects", "random_effects"),
    ]
    listed = rows.select("model_id", "model_type", F.explode(F.array(*sources)).alias("s"))
    listed = listed.where(F.col("model_type").isNotNull() | (F.col("s.source") != "parameters"))
    return listed.select("model_id", "s.*")


def profile_documents(registry: DataFrame) -> DataFrame:
    """The nested description of each model as JSON."""
    # at most one row per kind of uncertainty: seven per model
    parts = uncertainty_profile(registry).groupBy("model_id").agg(
        F.array_sort(
            F.collect_set(F.struct("source", "present", "data_driven", "propagates", "assimilation"))
        ).alias("uncertainty")
    )
    rows = registered_models(registry).join(parts, "model_id")
    description = F.struct(
        F.col("long_name").alias("name"), F.col("model_type").alias("type"), F.col("repository")
    ).alias("model_description")
    return rows.select("model_id", F.to_json(F.struct("model_id", description, "uncertainty")).alias("document"))


def model_type_counts(registry: DataFrame) -> DataFrame:
    kind = F.when(F.col("model_type").contains("mpirical"), F.lit("Empirical")).otherwise(F.col("model_type"))
    return registry.groupBy(kind.alias("model_type")).agg(F.count(F.lit(1)).alias("n"))
