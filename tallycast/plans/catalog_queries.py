"""Queries on the catalog's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallycast.operators import catalog as ops
from tallycast.plans.registry import query
from tallycast.plans.submission_queries import listed_store
from tallycast.schema import BUNDLE_PARTITIONS
from tallycast.session import shared_folder

_SITES = """SELECT DISTINCT s.model_id, s.variable, s.duration, s.site_id FROM scores s
 JOIN sites p ON p.field_site_id = s.site_id AND p.latitude < 55 WHERE s.model_id IS NOT NULL AND s.duration IN ('P1D', 'P1W')"""
_registered_sites = lambda inp: inp.sites.where(F.col("latitude") < 55)
_EXTENTS = """SELECT variable, duration, model_id, min(datetime) AS date_min, max(datetime) AS date_max,
 min(reference_datetime) AS reference_min, max(reference_datetime) AS reference_max, min(pub_datetime) AS pub_min,
 max(pub_datetime) AS pub_max FROM scores GROUP BY variable, duration, model_id"""
_NAMES = """SELECT event_type AS variable, CASE WHEN event_type < 'purchase' THEN 'group_a' ELSE 'group_b' END AS target_group,
 upper(event_type) AS full_name FROM events WHERE event_type <> 'signup' GROUP BY event_type"""


def _names(inp):
    kinds = inp.events.select(F.col("event_type").alias("variable")).distinct().where("variable <> 'signup'")
    group = F.when(F.col("variable") < "purchase", F.lit("group_a")).otherwise(F.lit("group_b"))
    return kinds.withColumns({"target_group": group, "full_name": F.upper("variable")})


@query("model_sites", "scores sites", _SITES)
def _(inp):
    return ops.model_sites(inp.scores, _registered_sites(inp))


@query("model_extents", "scores", _EXTENTS)
def _(inp):
    return ops.model_extents(inp.scores)


_ANSWERS = (
    "long_name, model_type, repository, is_dynamic, uses_drivers, assimilation_method, initial_conditions, "
    "parameters_used, parameters, drivers, process, noise, structure, random_effects, assimilation"
)
_FILLED = " + ".join(f"({c} IS NOT NULL)::INTEGER" for c in _ANSWERS.split(", "))
_TWICE = (
    "SELECT * FROM registry UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS long_name, CAST(NULL AS VARCHAR) AS repository) "
    "FROM registry WHERE is_dynamic = 'Yes'"
)
_REGISTERED = f"""SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER (PARTITION BY model_id, project_id
 ORDER BY {_FILLED} DESC) AS i FROM ({_TWICE}) t) r WHERE i = 1"""


def _twice(inp):
    none = F.lit(None).cast("string")
    again = inp.registry.where("is_dynamic = 'Yes'").withColumns({"long_name": none, "repository": none})
    return inp.registry.unionByName(again)


@query("registered_models", "registry", _REGISTERED)
def _(inp):
    return ops.registered_models(_twice(inp))


_DURATION = "CASE e.duration WHEN 'P1D' THEN 'Daily' WHEN 'PT1H' THEN 'Hourly' WHEN 'PT30M' THEN '30min' WHEN 'P1W' THEN 'Weekly' ELSE e.duration END"


@query(
    "catalog_items",
    "scores sites registry",
    f"""SELECT n.target_group, e.variable, e.duration, e.model_id, r.long_name, e.date_min, e.date_max,
               coalesce(e.pub_max, e.reference_max) AS published, {_DURATION} AS duration_name,
               concat({_DURATION}, ' ', coalesce(n.full_name, e.variable)) AS variable_name,
               concat({_DURATION}, '_', coalesce(n.full_name, e.variable)) AS item_title,
               CAST(s.n_sites AS INTEGER) AS n_sites, s.site_list
        FROM ({_EXTENTS}) e JOIN ({_REGISTERED}) r ON r.model_id = e.model_id AND r.model_id NOT LIKE '%example%'
        LEFT JOIN (SELECT variable, duration, model_id, count(*) AS n_sites, string_agg(site_id, ', ' ORDER BY site_id) AS site_list
                   FROM ({_SITES}) x GROUP BY variable, duration, model_id) s
          ON s.variable = e.variable AND s.duration = e.duration AND s.model_id = e.model_id
        LEFT JOIN ({_NAMES}) n ON n.variable = e.variable""",
)
def _(inp):
    return ops.catalog_items(inp.scores, _registered_sites(inp), _twice(inp), _names(inp))


@query(
    "group_extents",
    "scores",
    f"""SELECT n.target_group, min(s.datetime) AS first, max(s.datetime) AS last, count(DISTINCT s.site_id) AS n_sites
        FROM scores s JOIN ({_NAMES}) n ON n.variable = s.variable GROUP BY n.target_group""",
)
def _(inp):
    return ops.group_extents(inp.scores, _names(inp))


@query(
    "path_inventory",
    "forecasts",
    """SELECT DISTINCT project_id, duration, variable, model_id, CAST(NULL AS VARCHAR) AS reference_datetime,
              strftime(reference_datetime, '%Y-%m-%d') AS date FROM forecasts""",
)
def _(inp):
    return ops.path_inventory(listed_store(inp, "date", [*BUNDLE_PARTITIONS, "date"]))


@query(
    "site_features",
    "sites",
    """SELECT field_site_id AS site_id, concat('{"type":"Feature","geometry":{"type":"Point","coordinates":[',
              CAST(longitude AS VARCHAR), ',', CAST(latitude AS VARCHAR), ']},"properties":{"site_id":"', field_site_id, '"}}')
              AS feature FROM sites""",
)
def _(inp):
    return ops.site_features(inp.sites)


_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_SPARK_TYPES = "CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END"
_DESCRIBED = " UNION ALL ".join(
    f"SELECT '{c}' AS name, concat(CAST(min({c}) AS VARCHAR), ' to ', CAST(max({c}) AS VARCHAR)) AS description FROM orders" for c in _ORDERS
)


@query(
    "column_descriptions",
    "",
    f"""SELECT name, CAST(column_index AS INTEGER) AS position, {_SPARK_TYPES} AS type, description
        FROM (SELECT column_name AS name, row_number() OVER (ORDER BY column_index) - 1 AS column_index, data_type
              FROM duckdb_columns() WHERE table_name = 'orders' AND column_name IN ({", ".join(repr(c) for c in _ORDERS)})) c
        JOIN ({_DESCRIBED}) d USING (name)""",
)
def _(inp):
    # described by the first and last value each column takes: one scan, then a row per column
    table = inp.orders.select(*_ORDERS)
    ends = table.agg(*[F.concat_ws(" to ", F.min(c).cast("string"), F.max(c).cast("string")).alias(c) for c in _ORDERS])
    dictionary = ends.unpivot([], _ORDERS, "name", "description")
    return ops.column_descriptions(inp.spark, table, dictionary)


@query("target_date_range", "targets", "SELECT min(datetime) AS first, max(datetime) AS last FROM targets")
def _(inp):
    return ops.target_date_range(inp.targets)


def _profile_sql() -> str:
    def entry(source, present, driven, propagated, assimilation="CAST(NULL AS VARCHAR)"):
        return f"""SELECT model_id, '{source}' AS source,
          CASE WHEN model_type IS NULL THEN 'Unknown' ELSE {present} END AS present,
          CASE WHEN model_type IS NOT NULL THEN {driven} END AS data_driven,
          CASE WHEN model_type IS NOT NULL AND {propagated} THEN 'Infer from family column in archived forecasts' END AS propagates,
          CASE WHEN model_type IS NOT NULL THEN {assimilation} END AS assimilation FROM registry"""

    def estimated(source, column):
        present = f"CASE WHEN {column} LIKE 'Yes%' THEN 'true' WHEN {column} = 'No' THEN 'false' ELSE 'Unknown' END"
        driven = f"CASE WHEN {column} LIKE 'Yes%not estimated%' THEN false WHEN {column} LIKE 'Yes%' THEN true END"
        return entry(source, present, driven, f"{column} LIKE 'Yes%'")

    state = "CASE WHEN assimilation IN ('Initial conditions', 'Both initial conditions and parameters') THEN assimilation_method END"
    update = "CASE WHEN assimilation IN ('Parameter', 'Both initial conditions and parameters') THEN assimilation_method END"
    assumed = "coalesce(parameters_used = 'Yes and they are not estimated from data', false)"
    return " UNION ALL ".join(
        [
            entry(
                "initial_conditions",
                "CASE WHEN initial_conditions LIKE 'Yes%' OR (initial_conditions = 'No' AND is_dynamic = 'Yes') THEN 'true' "
                "WHEN initial_conditions = 'No' THEN 'false' ELSE 'Unknown' END",
                "CASE WHEN initial_conditions = 'Yes and they were estimated from data' THEN true WHEN initial_conditions LIKE 'Yes%' "
                "OR (initial_conditions = 'No' AND is_dynamic = 'Yes') THEN false END",
                "initial_conditions LIKE 'Yes%'",
                state,
            ),
            entry(
                "parameters",
                f"CASE WHEN {assumed} OR parameters = 'Yes' THEN 'true' END",
                f"CASE WHEN {assumed} THEN false WHEN parameters = 'Yes' THEN true END",
                "parameters = 'Yes'",
                update,
            )
            + " WHERE model_type IS NOT NULL",
            entry(
                "drivers",
                "CASE WHEN drivers = 'Yes' OR (drivers = 'No' AND uses_drivers = 'Yes') THEN 'true' WHEN drivers = 'No' THEN 'false' "
                "ELSE 'Unknown' END",
                "CASE WHEN drivers = 'Yes' OR (drivers = 'No' AND uses_drivers = 'Yes') THEN true END",
                "drivers = 'Yes'",
            ),
            estimated("process_error", "process"),
            estimated("obs_error", "noise"),
            entry(
                "structural_error",
                "CASE structure WHEN 'Yes' THEN 'true' WHEN 'No' THEN 'false' ELSE 'Unknown' END",
                "CASE WHEN structure = 'Yes' THEN false END",
                "structure = 'Yes'",
            ),
            estimated("random_effects", "random_effects"),
        ]
    )


@query("uncertainty_profile", "registry", _profile_sql())
def _(inp):
    return ops.uncertainty_profile(inp.registry)


@query("profile_documents", "registry")
def _(inp):
    return ops.profile_documents(_twice(inp))


@query(
    "model_type_counts",
    "registry",
    """SELECT CASE WHEN model_type LIKE '%mpirical%' THEN 'Empirical' ELSE model_type END AS model_type, count(*) AS n
       FROM registry GROUP BY 1""",
)
def _(inp):
    folder = shared_folder(inp.spark, "registry")
    inp.registry.write.json(folder)
    return ops.model_type_counts(inp.spark.read.schema(inp.registry.schema).json(folder))
