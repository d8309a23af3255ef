"""Queries on weather drivers."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tallycast.functions.timing import day, floor_to, ntz
from tallycast.operators import drivers as ops
from tallycast.operators.series import interpolate_linear
from tallycast.plans.registry import query

_at = lambda text: ntz(F.lit(text))


def interpolated(source: str, keys: str, order: str, value: str) -> str:
    """Linear gap filling by row number, ends held."""
    return f"""SELECT * EXCLUDE (i_, pp_, np_, pv_, nv_) REPLACE (CASE WHEN {value} IS NOT NULL THEN {value} WHEN pp_ IS NULL THEN nv_
      WHEN np_ IS NULL THEN pv_ ELSE pv_ + (nv_ - pv_) * (i_ - pp_) / (np_ - pp_) END AS {value}) FROM (
      SELECT *, max(CASE WHEN {value} IS NOT NULL THEN i_ END) OVER b_ AS pp_, min(CASE WHEN {value} IS NOT NULL THEN i_ END) OVER a_ AS np_,
             last_value({value} IGNORE NULLS) OVER b_ AS pv_, first_value({value} IGNORE NULLS) OVER a_ AS nv_
      FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS i_ FROM ({source}) s_) n_
      WINDOW b_ AS (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             a_ AS (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) w_"""


def _grid(source: str, cycle: str, variables: list[str]) -> str:
    member = ", ".join(dict.fromkeys([cycle, "site_id", "family", "ensemble"]))
    listed = ", ".join(f"'{v}'" for v in variables)
    return f"""SELECT {member}, variable, unnest(range(first_, last_ + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS datetime FROM (
      SELECT m.*, f.first_, unnest([{listed}]) AS variable
      FROM (SELECT {member}, max(datetime) AS last_ FROM {source} GROUP BY {member}) m
      JOIN (SELECT {cycle}, min(datetime) AS first_ FROM {source} GROUP BY {cycle}) f ON f.{cycle} = m.{cycle}) g"""


def _keys(cycle: str) -> str:
    return ", ".join(dict.fromkeys([cycle, "site_id", "family", "ensemble", "variable"]))


def _states(source: str, cycle: str, where: str = "true") -> str:
    keys = _keys(cycle)
    rows = f"""SELECT g.*, v.prediction FROM ({_grid(source, cycle, ops.STATES)}) g LEFT JOIN (SELECT * FROM {source} s WHERE {where}) v
               USING ({keys}, datetime)"""
    filled = interpolated(rows, keys, "datetime", "prediction")
    return f"""SELECT * REPLACE (CASE variable WHEN 'TMP' THEN prediction + 273 WHEN 'RH' THEN prediction / 100 ELSE prediction END
               AS prediction) FROM ({filled}) f"""


def _fluxes(source: str, cycle: str, where: str = "true") -> str:
    keys = _keys(cycle)
    return f"""SELECT * REPLACE (CASE WHEN variable = 'APCP' THEN prediction / 21600 ELSE prediction END AS prediction,
                      CASE WHEN variable = 'APCP' THEN 'PRATE' ELSE variable END AS variable) FROM (
      SELECT * REPLACE (first_value(prediction IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY datetime
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS prediction)
      FROM (SELECT g.*, v.prediction FROM ({_grid(source, cycle, ops.FLUXES)}) g LEFT JOIN (SELECT * FROM {source} s WHERE {where}) v
            USING ({keys}, datetime)) r) f"""


_DOY = "(extract(doy FROM datetime) + extract(hour FROM datetime) / 24.0::DOUBLE)"


def _radiation(source: str) -> str:
    """By the hours from the sun's noon: its height then, less what the turn since costs."""
    return f"""SELECT * EXCLUDE (lat, dec, from_noon),
      1366 * greatest(cos(lat - dec) - 2 * cos(lat) * cos(dec) * pow(sin(pi() * from_noon / 24), 2), 0) AS rpot
      FROM (SELECT s.*, radians(p.latitude) AS lat, -radians(23.45::DOUBLE) * cos(2 * pi() * (doy + 10) / 365) AS dec,
              hour - (12 - p.longitude / 15 - late / 3600) AS from_noon
      FROM ({source}) s
      JOIN (SELECT datetime AS at, doy, hour, -104.7::DOUBLE * sin(f) + 596.2::DOUBLE * sin(2 * f) + 4.3::DOUBLE * sin(4 * f)
                   - 429.3::DOUBLE * cos(f) - 2 * cos(2 * f) + 19.3::DOUBLE * cos(3 * f) AS late
            FROM (SELECT *, radians(279.5 + 0.9856 * doy) AS f FROM (
              SELECT datetime, {_DOY} AS doy, extract(hour FROM datetime) AS hour FROM (SELECT DISTINCT datetime FROM ({source}) x) y) z) w) e
        ON e.at = s.datetime
      LEFT JOIN sites p ON p.field_site_id = s.site_id) d"""


def _downscaled(fluxes: str, cycle: str) -> str:
    member = _keys(cycle)
    return f"""SELECT * EXCLUDE (rpot, s_, m_) REPLACE (CASE WHEN s_ > 0 THEN rpot * (m_ / s_) ELSE prediction END AS prediction) FROM (
      SELECT *, avg(rpot) OVER d_ AS s_, avg(prediction) OVER d_ AS m_ FROM ({_radiation(f"SELECT * FROM ({fluxes}) x WHERE variable = 'DSWRF'")}) r
      WINDOW d_ AS (PARTITION BY {member}, date_trunc('day', datetime))) w
      UNION ALL BY NAME SELECT * FROM ({fluxes}) y WHERE variable <> 'DSWRF'"""


def _named(states: str, fluxes: str, legacy: bool = False) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in (ops.LEGACY_NAMES if legacy else ops.NAMES).items())
    return f"""SELECT * REPLACE (CASE variable {cases} ELSE variable END AS variable) FROM (
      SELECT * FROM ({states}) a UNION ALL BY NAME SELECT * FROM ({fluxes}) b) u"""


def _numbered(source: str) -> str:
    return f"SELECT * EXCLUDE (ensemble), CAST(substring(ensemble, 4, 2) AS INTEGER) AS parameter FROM ({source}) q"


_CYCLE = ["reference_datetime"]
_C = "reference_datetime"


@query(
    "sites_union",
    "sites",
    """SELECT * FROM sites WHERE latitude < 40
       UNION ALL SELECT field_site_id, latitude, longitude FROM sites WHERE latitude >= 40""",
)
def _(inp):
    text = inp.sites.where(F.col("latitude") < 40).select(
        *[F.col(c).cast("string") for c in ("field_site_id", "latitude", "longitude")]
    )
    wide = inp.sites.where(F.col("latitude") >= 40).withColumn("note", F.lit("x"))
    return ops.sites_union([text, None, wide])


_EXPECTED = """SELECT field_site_id AS site_id, unnest(range(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-11 00:00:00',
  INTERVAL 1 DAY)) AS reference_date FROM sites"""
_MISSING = f"SELECT e.reference_date, e.site_id FROM ({_EXPECTED}) e ANTI JOIN pseudo_raw p ON p.site_id = e.site_id AND p.reference_datetime = e.reference_date"


@query("missing_partitions", "pseudo_raw sites", _MISSING)
def _(inp):
    return ops.missing_partitions(inp.pseudo_raw, inp.sites, day("2024-01-01"), day("2024-01-10"))


@query("incomplete_dates", "pseudo_raw sites", f"SELECT DISTINCT reference_date FROM ({_MISSING}) m")
def _(inp):
    return ops.incomplete_dates(inp.pseudo_raw, inp.sites, day("2024-01-01"), day("2024-01-10"))


_REPAIRED = """SELECT * REPLACE (reference_datetime + INTERVAL 1 HOUR * (CAST(horizon AS INTEGER) + CAST(cycle AS INTEGER)) AS datetime)
  FROM pseudo_raw"""


@query("valid_time_repair", "pseudo_raw", _REPAIRED)
def _(inp):
    return ops.repair_valid_time(inp.pseudo_raw)


@query("hourly_grid", "drivers_raw", _grid("drivers_raw", _C, ops.VARIABLES))
def _(inp):
    return ops.hourly_grid(inp.drivers_raw, _CYCLE)


@query("states_hourly", "drivers_raw", _states("drivers_raw", _C), "prediction")
def _(inp):
    return ops.states_hourly(inp.drivers_raw, _CYCLE)


@query("fluxes_hourly", "drivers_raw", _fluxes("drivers_raw", _C), "prediction")
def _(inp):
    return ops.fluxes_hourly(inp.drivers_raw, _CYCLE)


@query("solar_geometry", "drivers_raw sites", _radiation("SELECT DISTINCT site_id, datetime FROM drivers_raw"), "rpot")
def _(inp):
    return ops.with_potential_radiation(inp.drivers_raw.select("site_id", "datetime").distinct(), inp.sites)


@query(
    "shortwave_downscale",
    "drivers_raw sites",
    _downscaled(_fluxes("drivers_raw", _C), _C),
    "prediction",
)
def _(inp):
    return ops.shortwave_downscale(ops.fluxes_hourly(inp.drivers_raw, _CYCLE), inp.sites, _CYCLE)


@query(
    "driver_rename",
    "drivers_raw",
    _named(
        "SELECT * FROM drivers_raw WHERE variable NOT IN ('APCP', 'DSWRF', 'DLWRF')",
        "SELECT * FROM drivers_raw WHERE variable IN ('APCP', 'DSWRF', 'DLWRF')",
        legacy=True,
    ),
)
def _(inp):
    return ops.rename_drivers(inp.drivers_raw, legacy=True)


@query(
    "stage2",
    "drivers_raw sites",
    _numbered(_named(_states("drivers_raw", _C), _downscaled(_fluxes("drivers_raw", _C), _C))),
    "prediction",
)
def _(inp):
    return ops.stage2(inp.drivers_raw, inp.sites)


def _record(source: str) -> str:
    ends = f"(SELECT max(datetime) FROM {source} m WHERE m.site_id = s.site_id)"
    states = _states(source, "site_id", f"(CAST(horizon AS INTEGER) <> 6 OR datetime = {ends})")
    return _numbered(
        _named(states, _downscaled(_fluxes(source, "site_id", "CAST(horizon AS INTEGER) <> 3"), "site_id"))
    )


_DAILY = "site_id, parameter, variable, CAST(date_trunc('day', datetime) AS TIMESTAMP) AS date"


@query(
    "stage3_backfill",
    "pseudo_raw sites",
    f"""WITH todo AS (SELECT * FROM ({_REPAIRED}) p WHERE site_id NOT IN (SELECT field_site_id FROM sites WHERE latitude < 30))
        SELECT {_DAILY}, count(*) AS n, avg(prediction) AS prediction, max(prediction) AS highest
        FROM ({_record('todo')}) r GROUP BY site_id, parameter, variable, date_trunc('day', datetime)""",
    "prediction highest",
)
def _(inp):
    done = inp.sites.where(F.col("latitude") < 30).select(F.col("field_site_id").alias("site_id"))
    hourly = ops.stage3_backfill(inp.pseudo_raw, inp.sites, done)
    by = ["site_id", "parameter", "variable", floor_to("day", "datetime").alias("date")]
    return hourly.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("prediction"), F.max("prediction").alias("highest")
    )


_HOURLY = """SELECT site_id, family, CAST(substring(ensemble, 4, 2) AS INTEGER) AS parameter, variable, datetime, prediction
             FROM drivers_raw WHERE prediction IS NOT NULL"""


def _hourly_at_short_names(inp):
    short = F.regexp_replace("site_id", "^S", "")
    rows = ops._member_number(inp.drivers_raw.where(F.col("prediction").isNotNull()))
    named = rows.withColumn("site_id", F.when(F.col("parameter") == 1, short).otherwise(F.col("site_id")))
    return named.select("site_id", "family", "parameter", "variable", "datetime", "prediction")


@query(
    "monthly_drivers",
    "drivers_raw",
    f"""WITH h AS (SELECT * REPLACE (CASE WHEN parameter = 1 THEN substring(site_id, 2) ELSE site_id END AS site_id) FROM ({_HOURLY}) q)
        SELECT * FROM h WHERE NOT (length(site_id) = 6 AND site_id NOT LIKE '%-%')
        UNION ALL BY NAME SELECT site_id, family, parameter, variable, min(datetime) AS datetime, avg(prediction) AS prediction
        FROM h WHERE length(site_id) = 6 AND site_id NOT LIKE '%-%'
        GROUP BY site_id, family, parameter, variable, date_trunc('month', datetime)""",
    "prediction",
)
def _(inp):
    return ops.monthly_drivers(_hourly_at_short_names(inp))


_STORED = """SELECT site_id, family, CAST(1 AS INTEGER) AS parameter, 'air_temperature' AS variable, datetime, CAST(0 AS DOUBLE) AS prediction
             FROM repaired WHERE variable = 'TMP' AND datetime < TIMESTAMP '2024-01-20 00:00:00'"""


@query(
    "stage3_update",
    "pseudo_raw sites",
    f"""WITH repaired AS ({_REPAIRED}), stored AS ({_STORED}),
        recent AS (SELECT r.* FROM repaired r JOIN (SELECT site_id, date_trunc('day', max(datetime)) - INTERVAL 3 DAY AS f FROM stored GROUP BY site_id) l
                   ON l.site_id = r.site_id WHERE r.reference_datetime >= l.f),
        hourly AS ({_record('recent')}),
        fresh AS (SELECT * FROM hourly WHERE NOT (length(site_id) = 6 AND site_id NOT LIKE '%-%')
                  UNION ALL BY NAME SELECT site_id, family, parameter, variable, avg(prediction) AS prediction, min(datetime) AS datetime
                  FROM hourly WHERE length(site_id) = 6 AND site_id NOT LIKE '%-%'
                  GROUP BY site_id, family, parameter, variable, date_trunc('month', datetime))
        SELECT s.* FROM stored s LEFT JOIN (SELECT site_id, min(datetime) AS a FROM fresh GROUP BY site_id) n ON n.site_id = s.site_id
        WHERE n.a IS NULL OR s.datetime < n.a
        UNION ALL BY NAME SELECT * FROM fresh""",
    "prediction",
)
def _(inp):
    at = F.col("datetime") < _at("2024-01-20 00:00:00")
    stored = ops.repair_valid_time(inp.pseudo_raw).where((F.col("variable") == "TMP") & at)
    stored = stored.select(
        "site_id",
        "family",
        F.lit(1).alias("parameter"),
        F.lit("air_temperature").alias("variable"),
        "datetime",
        F.lit(0.0).alias("prediction"),
    )
    return ops.stage3_update(stored, inp.pseudo_raw, inp.sites)


@query(
    "interpolate_linear",
    "history",
    interpolated("SELECT site_id, datetime, observation FROM history", "site_id", "datetime", "observation"),
    "observation",
)
def _(inp):
    rows = inp.history.select("site_id", "datetime", "observation")
    return interpolate_linear(rows, ["site_id"], "datetime", "observation")
