"""Queries on building observation tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tallycast.functions.timing import day, ntz
from tallycast.operators import targets as ops
from tallycast.plans.registry import query
from tallycast.plans.sqltext import uniform
from tallycast.session import shared_folder
from tallycast.sources.tables import scan_targets, write_csv

_at = lambda text: ntz(F.lit(text))

_SUFFIX = "CASE WHEN p = 'O3' THEN '' WHEN duration = 'PT1H' THEN '_P1H' ELSE '_P1D' END"
AIR = f"""
air AS (
  SELECT concat(state_code, '-', county_code, '-', site_number) AS site_id,
         CAST(concat(date_gmt, ' ', time_gmt, ':00') AS TIMESTAMP) AS datetime, duration,
         concat(p, {_SUFFIX}) AS variable, poc, sample_measurement AS observation,
         CAST(date_of_last_change AS TIMESTAMP) AS changed, CAST(date_local AS TIMESTAMP) AS date_local,
         units_of_measure, latitude, longitude
  FROM (SELECT *, CASE sample_duration WHEN '1 HOUR' THEN 'PT1H' ELSE 'P1D' END AS duration,
               CASE WHEN parameter LIKE 'PM2.5%' THEN 'PM2.5' WHEN parameter LIKE 'PM10%' THEN 'PM10'
                    WHEN parameter = 'Ozone' THEN 'O3' ELSE 'NO2' END AS p FROM air_raw) a),
latest AS (
  SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER (PARTITION BY datetime, variable, site_id, duration, poc
    ORDER BY changed DESC, observation DESC) AS i FROM air WHERE observation IS NOT NULL) r WHERE i = 1),
longest AS (
  SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER (PARTITION BY datetime, variable, site_id, duration
    ORDER BY sensor_days DESC, poc) AS i
  FROM (SELECT *, CAST(date_diff('day', min(datetime) OVER s, max(datetime) OVER s) AS INTEGER) AS sensor_days FROM latest
        WINDOW s AS (PARTITION BY site_id, variable, poc)) d) r WHERE i = 1),
coverage AS (
  SELECT site_id, variable, min(date_local) AS start_date, max(date_local) AS end_date,
         max(date_local) >= TIMESTAMP '2001-12-01 00:00:00' - INTERVAL 180 DAY AS active
  FROM air GROUP BY site_id, variable)
"""


def _air(inp):
    return ops.normalize_air_samples(inp.air_raw)


def _air_query(name: str, body: str, floats: str = ""):
    return query(name, "air_raw", f"WITH {AIR} {body}", floats)


@query(
    "targets_scan",
    "targets",
    """SELECT * FROM targets WHERE project_id = 'demo' AND datetime > TIMESTAMP '2024-01-05 00:00:00'
       AND observation IS NOT NULL""",
)
def _(inp):
    # through CSV files with NA for missing values, as targets are published
    folder = shared_folder(inp.spark, "target-files")
    write_csv(inp.targets.where(F.col("variable") <= "error"), os.path.join(folder, "a"))
    write_csv(inp.targets.where(F.col("variable") > "error"), os.path.join(folder, "b"))
    paths = [os.path.join(folder, "a"), os.path.join(folder, "b")]
    return scan_targets(inp.spark, paths, "demo", _at("2024-01-05 00:00:00"))


@_air_query("sensor_normalize", "SELECT * FROM air")
def _(inp):
    return _air(inp)


@_air_query("latest_revision", "SELECT * FROM latest")
def _(inp):
    return ops.latest_revision(_air(inp))


@_air_query("longest_sensor", "SELECT * FROM longest")
def _(inp):
    return ops.longest_sensor(ops.latest_revision(_air(inp)))


@_air_query("air_targets", "SELECT 'demo' AS project_id, site_id, datetime, duration, variable, observation FROM longest")
def _(inp):
    return ops.air_targets(inp.air_raw, "demo")


_KEY = "project_id, site_id, datetime, duration, variable"


@query(
    "target_upsert",
    "targets targets_new",
    f"""SELECT {_KEY}, round(observation, 6) AS observation FROM targets_new
        UNION ALL SELECT {_KEY}, round(observation, 6) FROM targets t ANTI JOIN targets_new n USING ({_KEY})""",
)
def _(inp):
    return ops.target_upsert(inp.targets, inp.targets_new)


@_air_query("site_coverage", "SELECT * FROM coverage")
def _(inp):
    return ops.site_coverage(_air(inp), day("2001-12-01"))


@_air_query(
    "site_places",
    """SELECT site_id, string_agg(lat, ', ' ORDER BY lat) AS latitude, string_agg(lon, ', ' ORDER BY lon) AS longitude
       FROM (SELECT DISTINCT site_id, CAST(latitude AS VARCHAR) AS lat, CAST(longitude AS VARCHAR) AS lon FROM air) d
       GROUP BY site_id""",
)
def _(inp):
    return ops.site_places(_air(inp))


_VARIABLES = ["PM2.5_P1D", "PM2.5_P1H", "PM10_P1D", "PM10_P1H", "O3", "NO2_P1D", "NO2_P1H"]


@_air_query(
    "site_coverage_wide",
    "SELECT site_id, "
    + ", ".join(
        f"max(start_date) FILTER (variable = '{v}') AS \"{v}_StartDate\", max(end_date) FILTER (variable = '{v}') AS "
        f"\"{v}_EndDate\", coalesce(bool_or(active) FILTER (variable = '{v}'), false) AS \"{v}_Active\""
        for v in _VARIABLES
    )
    + " FROM coverage GROUP BY site_id",
)
def _(inp):
    return ops.coverage_wide(ops.site_coverage(_air(inp), day("2001-12-01")), _VARIABLES)


@_air_query(
    "site_coverage_merge",
    """, o AS (SELECT site_id, variable, min(date_local) AS start_date, max(date_local) AS end_date, false AS active
               FROM air WHERE date_local < TIMESTAMP '1998-01-01 00:00:00' GROUP BY site_id, variable),
         n AS (SELECT site_id, variable, min(date_local) AS start_date, max(date_local) AS end_date,
                      max(date_local) >= TIMESTAMP '2001-12-01 00:00:00' - INTERVAL 180 DAY AS active
               FROM air WHERE date_local >= TIMESTAMP '2001-05-01 00:00:00' GROUP BY site_id, variable)
       SELECT coalesce(o.site_id, n.site_id) AS site_id, coalesce(o.variable, n.variable) AS variable,
              coalesce(o.start_date, n.start_date) AS start_date, coalesce(n.end_date, o.end_date) AS end_date,
              coalesce(n.active, o.active) AS active
       FROM o FULL JOIN n ON o.site_id = n.site_id AND o.variable = n.variable""",
)
def _(inp):
    air = _air(inp)
    old = ops.site_coverage(air.where(F.col("date_local") < day("1998-01-01")), day("2001-12-01"))
    new = ops.site_coverage(air.where(F.col("date_local") >= day("2001-05-01")), day("2001-12-01"))
    return ops.merge_coverage(old, new)


_UNITS = """SELECT variable, CAST(min(extract(year FROM datetime)) AS INTEGER) AS start_year,
 string_agg(DISTINCT units_of_measure, ', ' ORDER BY units_of_measure) AS units_of_measure FROM {where} GROUP BY variable"""


@_air_query("units_by_variable", _UNITS.format(where="air"))
def _(inp):
    return ops.units_by_variable(_air(inp))


@_air_query(
    "units_merge",
    f""", o AS ({_UNITS.format(where="air WHERE datetime < TIMESTAMP '1998-01-01 00:00:00' AND variable <> 'O3'")}),
          n AS ({_UNITS.format(where="air WHERE datetime >= TIMESTAMP '1998-01-01 00:00:00'")})
        SELECT coalesce(o.variable, n.variable) AS variable, o.start_year,
               CASE WHEN o.units_of_measure IS NULL THEN n.units_of_measure WHEN n.units_of_measure IS NULL
                    THEN o.units_of_measure ELSE concat(o.units_of_measure, CASE WHEN len(list_filter(
                      string_split(n.units_of_measure, ', '), lambda u: NOT list_contains(string_split(o.units_of_measure, ', '), u))) > 0
                      THEN concat(', ', array_to_string(list_filter(string_split(n.units_of_measure, ', '),
                      lambda u: NOT list_contains(string_split(o.units_of_measure, ', '), u)), ', ')) ELSE '' END) END
               AS units_of_measure
        FROM o FULL JOIN n ON o.variable = n.variable""",
)
def _(inp):
    air = _air(inp)
    split = _at("1998-01-01 00:00:00")
    old = ops.units_by_variable(air.where((F.col("datetime") < split) & (F.col("variable") != "O3")))
    return ops.merge_units(old, ops.units_by_variable(air.where(F.col("datetime") >= split)))


@_air_query(
    "availability_ranges",
    "SELECT variable, site_id, min(datetime) AS start, max(datetime) AS end FROM air GROUP BY variable, site_id",
)
def _(inp):
    return ops.availability_ranges(_air(inp))


@_air_query(
    "overlapping_sensors",
    """SELECT * EXCLUDE (n) FROM (SELECT site_id, variable, poc, min(datetime) AS start, max(datetime) AS end,
              CAST(date_diff('day', min(datetime), max(datetime)) AS INTEGER) AS span_days,
              count(*) OVER (PARTITION BY site_id, variable) AS n FROM air GROUP BY site_id, variable, poc) s WHERE n > 1""",
)
def _(inp):
    return ops.overlapping_sensors(_air(inp))


_BUOY = """SELECT {by} CAST(date_trunc('day', time) AS TIMESTAMP) AS date, avg(chlorophyll) AS chlorophyll,
  avg(temperature) AS temperature, avg(turbidity) AS turbidity, count(*) AS n_obs FROM buoy_raw
  WHERE longitude > -180 AND longitude < 180 AND latitude > -90 AND latitude < 90 GROUP BY {by} date_trunc('day', time)"""


@query("sensor_daily_mean", "buoy_raw", _BUOY.format(by="platform,"), "chlorophyll temperature turbidity")
def _(inp):
    return ops.sensor_daily_mean(inp.buoy_raw, ["chlorophyll", "temperature", "turbidity"], ["platform"])


@query(
    "grid_window_stats",
    "grid",
    """WITH la AS (SELECT lat, row_number() OVER (ORDER BY lat) AS i FROM (SELECT DISTINCT lat FROM grid) d),
            lo AS (SELECT lon, row_number() OVER (ORDER BY lon) AS i FROM (SELECT DISTINCT lon FROM grid) d),
            c AS (SELECT (SELECT i FROM la ORDER BY pow(lat - 33.2, 2), i LIMIT 1) AS ci,
                         (SELECT i FROM lo ORDER BY pow(lon + 79.6, 2), i LIMIT 1) AS cj)
       SELECT CAST(date AS TIMESTAMP) AS date, avg(value) AS mean, stddev_samp(value) AS sd, count(value) AS n
       FROM grid g JOIN la ON g.lat = la.lat JOIN lo ON g.lon = lo.lon, c
       WHERE abs(la.i - ci) <= 2 AND abs(lo.i - cj) <= 2 GROUP BY date""",
    "mean sd",
)
def _(inp):
    return ops.grid_window_stats(inp.grid, 33.2, -79.6)


@query(
    "to_target_long",
    "buoy_raw",
    f"""SELECT 'demo' AS project_id, concat('B', CAST(platform AS VARCHAR)) AS site_id, date AS datetime,
               'P1D' AS duration, 'chla_probe' AS variable, chlorophyll AS observation
        FROM ({_BUOY.format(by="platform,")}) b WHERE chlorophyll IS NOT NULL AND chlorophyll > 0.001""",
    "observation",
)
def _(inp):
    daily = ops.sensor_daily_mean(inp.buoy_raw, ["chlorophyll"], ["platform"])
    site = F.concat(F.lit("B"), F.col("platform").cast("string"))
    values = daily.withColumn("value", F.col("chlorophyll"))
    return ops.to_target_long(values, "demo", site, "chla_probe", "P1D", above=0.001)


_DAYS = """SELECT CAST(r.d AS TIMESTAMP) AS date FROM (SELECT unnest(range({start}, TIMESTAMP '2002-02-01 00:00:00',
  INTERVAL 1 DAY)) AS d) r WHERE r.d NOT IN (SELECT datetime FROM history)"""


@query(
    "missing_dates",
    "history",
    _DAYS.format(start="(SELECT max(datetime) + INTERVAL 1 DAY FROM history)"),
)
def _(inp):
    return ops.missing_dates(inp.history, "temperature", day("1995-01-01"), day("2002-02-01"))


@query("unstored_dates", "history", _DAYS.format(start="TIMESTAMP '1994-12-01 00:00:00'"))
def _(inp):
    return ops.unstored_dates(inp.history, "temperature", day("1994-12-01"), day("2002-02-01"))


_PAIRS = """
pairs AS (SELECT site_id, datetime, probe, reference, probe / reference AS ratio,
                 CAST(extract(month FROM datetime) AS INTEGER) AS month
          FROM (SELECT site_id, datetime, avg(observation) FILTER (variable = 'chla_probe') AS probe,
                       avg(observation) FILTER (variable = 'chla_satellite') AS reference
                FROM paired GROUP BY site_id, datetime) w WHERE probe > 0 AND reference > 0),
outliers AS (SELECT DISTINCT site_id, datetime FROM pairs WHERE ratio > 5 OR ratio < 0.2 OR reference <= 0.001),
correction AS (SELECT month, quantile_cont(ratio, 0.5) AS median_ratio FROM pairs p ANTI JOIN outliers o
               USING (site_id, datetime) GROUP BY month)"""


def _pairs(inp):
    return ops.paired_ratios(inp.paired, "chla_probe", "chla_satellite", ["site_id"])


@query("paired_ratios", "paired", f"WITH {_PAIRS} SELECT * FROM pairs", "ratio")
def _(inp):
    return _pairs(inp)


@query("ratio_outlier_dates", "paired", f"WITH {_PAIRS} SELECT * FROM outliers")
def _(inp):
    return ops.ratio_outlier_dates(_pairs(inp))


@query("monthly_correction", "paired", f"WITH {_PAIRS} SELECT * FROM correction", "median_ratio")
def _(inp):
    pairs = _pairs(inp)
    return ops.monthly_correction(pairs, ops.ratio_outlier_dates(pairs))


@query(
    "apply_correction",
    "paired",
    f"""WITH {_PAIRS} SELECT project_id, site_id, datetime, duration, 'chla_corrected' AS variable,
               CASE WHEN median_ratio > 0 THEN observation / median_ratio ELSE observation END AS observation
        FROM (SELECT * FROM paired p ANTI JOIN outliers o USING (site_id, datetime) WHERE variable = 'chla_probe') p
        LEFT JOIN correction c ON c.month = extract(month FROM p.datetime)
        UNION ALL SELECT project_id, site_id, datetime, duration, variable, observation FROM paired
        WHERE variable = 'chla_satellite'""",
    "observation",
)
def _(inp):
    pairs = _pairs(inp)
    outliers = ops.ratio_outlier_dates(pairs)
    correction = ops.monthly_correction(pairs, outliers)
    return ops.apply_correction(inp.paired, outliers, correction, "chla_probe", "chla_satellite", "chla_corrected")


@query(
    "monthly_case_counts",
    "cases",
    """SELECT 'demo' AS project_id, place AS site_id, CAST(date_trunc('month', d) AS TIMESTAMP) AS datetime,
              'P1M' AS duration, 'cases' AS variable, CAST(count(*) AS DOUBLE) AS observation
       FROM (SELECT place, CASE WHEN extract(year FROM onset_date) >= 1997 AND extract(year FROM onset_date) >= birth_year
                                THEN onset_date ELSE notified_date END AS d FROM cases) c
       WHERE place IS NOT NULL AND d IS NOT NULL GROUP BY place, date_trunc('month', d)""",
)
def _(inp):
    return ops.monthly_case_counts(inp.cases, "demo", "cases", first_year=1997)


@query(
    "wide_to_long",
    "camera_daily",
    """SELECT site_id, datetime, 'gcc_90' AS variable, gcc_90 AS observation FROM camera_daily
       UNION ALL SELECT site_id, datetime, 'rcc_90', rcc_90 FROM camera_daily""",
)
def _(inp):
    return ops.wide_to_long(inp.camera_daily, ["site_id", "datetime"], ["gcc_90", "rcc_90"])


@query(
    "calendar_densify",
    "targets",
    """SELECT s.site_id, v.variable, d.datetime, t.observation
       FROM (SELECT DISTINCT site_id FROM targets) s CROSS JOIN (SELECT unnest(['view', 'click', 'error']) AS variable) v
       CROSS JOIN (SELECT unnest(range(min(datetime), max(datetime) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS datetime
                   FROM targets) d
       LEFT JOIN targets t ON t.site_id = s.site_id AND t.variable = v.variable AND t.datetime = d.datetime""",
)
def _(inp):
    return ops.calendar_densify(inp.targets, ["view", "click", "error"])


@query(
    "fill_gaps",
    "targets",
    """SELECT s.site_id, s.variable, s.datetime, t.observation
       FROM (SELECT site_id, variable, unnest(range(min(datetime), TIMESTAMP '2024-02-03 00:00:00', INTERVAL 1 DAY))
             AS datetime FROM targets GROUP BY site_id, variable) s
       LEFT JOIN targets t ON t.site_id = s.site_id AND t.variable = s.variable AND t.datetime = s.datetime""",
)
def _(inp):
    return ops.fill_gaps(inp.targets, ["site_id", "variable"], day("2024-02-02"))


# the place of the first order statistic is found by halving the distribution of its count
_TAIL = """list_sum(list_transform(range(k, n + 1), lambda i: exp(
  lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(lo + w) + (n - i) * ln(1 - lo - w))))"""


@query(
    "bootstrap_quantile_sd",
    "",
    f"""SELECT date, stddev_samp(q) AS sd FROM (
  SELECT date, b, sum(value * weight) AS q FROM (
    SELECT date, b, unnest([greatest(least(ceil(low * n), n), 1), greatest(least(ceil(high * n), n), 1)])::BIGINT AS pos,
           unnest([1 - part, part]) AS weight FROM (
      SELECT *, CASE WHEN n > k THEN 1 - (1 - low) * pow(u2, 1.0::DOUBLE / (n - k)) ELSE low END AS high FROM (
        SELECT *, list_reduce(list_concat([0.0::DOUBLE], list_transform(range(1, 54), lambda e: pow(2.0::DOUBLE, -e))),
                              lambda lo, w: CASE WHEN {_TAIL} < u1 THEN lo + w ELSE lo END) AS low FROM (
          SELECT *, floor((n - 1) * 0.9::DOUBLE)::BIGINT + 1 AS k, (n - 1) * 0.9::DOUBLE - floor((n - 1) * 0.9::DOUBLE) AS part,
                 {uniform('date', 'b', "'low'")} AS u1, {uniform('date', 'b', "'high'")} AS u2 FROM (
            SELECT date_trunc('day', ts)::TIMESTAMP AS date, count(value) AS n, unnest(range(1, 51)) AS b FROM events GROUP BY 1) g) u) l) h) p
  JOIN (SELECT date_trunc('day', ts)::TIMESTAMP AS date, value, row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY value) AS pos
        FROM events WHERE value IS NOT NULL) v USING (date, pos)
  GROUP BY date, b) r GROUP BY date""",
    "sd",
)
def _(inp):
    images = inp.events.select(ntz(F.date_trunc("day", "ts")).alias("date"), "event_id", "value")
    return ops.bootstrap_quantile_sd(images, ["date"], "value")


def _qc_sql(source: str, keys: str, by_depth: bool) -> str:
    flag = """((abs(x) > 5 AND NOT opens) OR NOT (observation BETWEEN -5 AND 40) OR (x = 0 AND NOT opens))"""
    keep = f"CASE WHEN coalesce(NOT {flag}, true) THEN observation END" if by_depth else (
        f"CASE WHEN NOT {flag} THEN observation END"
    )
    return f"""SELECT * EXCLUDE (x, opens) REPLACE ({keep} AS observation) FROM (
      SELECT *, observation - lag(observation) OVER w AS x, row_number() OVER w = 1 AS opens FROM ({source}) q
      WINDOW w AS (PARTITION BY {keys} ORDER BY datetime)) f"""


@query("qc_series", "history", _qc_sql("SELECT * FROM history", "site_id", False))
def _(inp):
    return ops.qc_series(inp.history, -5, 40, 5)


@query(
    "standard_error",
    "history",
    """SELECT site_id, stddev_samp(observation) / sqrt(count(observation)) AS se FROM history GROUP BY site_id""",
    "se",
)
def _(inp):
    return inp.history.groupBy("site_id").agg(ops.standard_error("observation").alias("se"))


def _best(name: str) -> str:
    return (
        f"coalesce(e.{name}, CASE WHEN s.sampleType = 'other carabid' THEN p.{name} END, s.{name}) AS {name}"
    )


@query(
    "resolve_taxonomy",
    "taxonomy_sorting taxonomy_para taxonomy_expert",
    f"""SELECT DISTINCT *, CASE WHEN taxonRank IN ('subgenus', 'genus', 'family', 'order') AND morphospeciesID IS NOT NULL
               THEN morphospeciesID ELSE array_to_string(list_slice(regexp_extract_all(
                 split_part(scientificName, '/', 1), '[[:alnum:]_]+'), 1, 2), ' ') END AS morphospecies
        FROM (SELECT s.subsampleID, p.individualID, s.sampleType, e.family, {_best('taxonRank')},
                     {_best('scientificName')}, {_best('taxonID')}, {_best('morphospeciesID')},
                     coalesce(e.nativeStatusCode, s.nativeStatusCode) AS nativeStatusCode,
                     coalesce(e.sampleCondition, s.sampleCondition) AS sampleCondition
              FROM taxonomy_sorting s LEFT JOIN taxonomy_para p ON s.subsampleID = p.subsampleID
              LEFT JOIN taxonomy_expert e ON p.individualID = e.individualID) t
        WHERE sampleType LIKE '%carabid%' AND (family IS NULL OR family = 'Carabidae')""",
)
def _(inp):
    return ops.resolve_taxonomy(inp.taxonomy_sorting, inp.taxonomy_para, inp.taxonomy_expert)


def _eav_sql(terms: list[str], by: str, source: str = "sensor_eav") -> str:
    value = "coalesce(doubleValue, CAST(intValue AS DOUBLE))"
    picks = ", ".join(f"max(CASE WHEN termName = '{t}' THEN {value} END) AS {t}" for t in terms)
    listed = ", ".join(f"'{t}'" for t in terms)
    return f"""SELECT {by}, {picks} FROM {source} WHERE termName IN ({listed})
               AND horizontalIndex IN ('101', '111', '103') GROUP BY {by}"""


_PROFILING = ["L000001", "L000004", "L000009"]
_STREAMS = ["L000002", "L000003"]
_WQ = f"""WITH daily AS (
  SELECT siteName AS site_id, CAST(date_trunc('day', startDate) AS TIMESTAMP) AS datetime, avg(dissolvedOxygen) AS oxygen,
         avg(chlorophyll) AS chla
  FROM (SELECT *, CASE WHEN siteName IN ('L000001', 'L000004', 'L000009') THEN sensorDepth ELSE 0.5 END AS depth
        FROM ({_eav_sql(['dissolvedOxygen', 'chlorophyll', 'sensorDepth', 'oxygenQF', 'chlorophyllQF'], 'siteName, startDate')}) w
        WHERE oxygenQF <> 1 {{op}} chlorophyllQF <> 1) d WHERE depth > 0 AND depth < 1
  GROUP BY siteName, date_trunc('day', startDate))
SELECT site_id, datetime, 'oxygen' AS variable, oxygen AS observation FROM daily
UNION ALL SELECT site_id, datetime, 'chla', chla FROM daily WHERE site_id NOT IN ('L000002', 'L000003')"""


@query("wq_daily", "sensor_eav", _WQ.format(op="OR"), "observation")
def _(inp):
    return ops.wq_daily(inp.sensor_eav, _PROFILING, _STREAMS)


@query("wq_daily_strict", "sensor_eav", _WQ.format(op="AND"), "observation")
def _(inp):
    return ops.wq_daily(inp.sensor_eav, _PROFILING, _STREAMS, flag_rule="all_ok")


_TEMP_ROWS = "(SELECT s.*{extra} FROM sensor_eav s {join} WHERE temporalIndex = '030') s"
_WITH_DEPTH = _TEMP_ROWS.format(
    extra=", d.thermistorDepth",
    join="JOIN sensor_depths d ON s.siteName = d.siteName AND s.verticalIndex = d.verticalIndex",
)
_DAILY_TEMP = """SELECT siteName AS site_id, CAST(date_trunc('day', startDate) AS TIMESTAMP) AS datetime,
 'temperature' AS variable, avg(waterTemp) AS observation FROM ({wide}) w WHERE tempQF <> 1 {limit}
 GROUP BY siteName, date_trunc('day', startDate)"""


@query(
    "temperature_daily",
    "sensor_eav sensor_depths",
    _qc_sql(
        _DAILY_TEMP.format(
            wide=_eav_sql(["waterTemp", "tempQF"], "siteName, startDate, verticalIndex, thermistorDepth", _WITH_DEPTH),
            limit="AND thermistorDepth <= 1.0",
        ),
        "site_id",
        False,
    ),
    "observation",
)
def _(inp):
    return ops.temperature_daily(inp.sensor_eav, inp.sensor_depths)


@query(
    "surface_temperature_daily",
    "sensor_eav",
    _qc_sql(
        _DAILY_TEMP.format(
            wide=_eav_sql(
                ["waterTemp", "tempQF"], "siteName, startDate, verticalIndex", _TEMP_ROWS.format(extra="", join="")
            ),
            limit="",
        ),
        "site_id",
        False,
    ),
    "observation",
)
def _(inp):
    return ops.surface_temperature_daily(inp.sensor_eav)


@query(
    "temperature_hourly_profile",
    "sensor_eav sensor_depths",
    _qc_sql(
        f"""SELECT siteName AS site_id, thermistorDepth AS depth, CAST(date_trunc('hour', startDate) AS TIMESTAMP) AS datetime,
                   'temperature' AS variable, avg(waterTemp) AS observation, 'raw' AS source
            FROM ({_eav_sql(["waterTemp", "tempQF"], "siteName, startDate, verticalIndex, thermistorDepth", _WITH_DEPTH)}) w
            WHERE tempQF <> 1 GROUP BY siteName, thermistorDepth, date_trunc('hour', startDate)""",
        "site_id, depth",
        True,
    ),
    "observation",
)
def _(inp):
    return ops.temperature_hourly_profile(inp.sensor_eav, inp.sensor_depths, "raw")


@query(
    "drop_superseded",
    "targets targets_new",
    """SELECT r.* FROM targets_new r LEFT JOIN (SELECT site_id, max(datetime) AS u FROM targets
       WHERE variable = 'view' AND datetime < TIMESTAMP '2024-01-28 00:00:00' GROUP BY site_id) p ON r.site_id = p.site_id
       WHERE p.u IS NULL OR r.datetime > p.u""",
)
def _(inp):
    published = inp.targets.where((F.col("variable") == "view") & (F.col("datetime") < _at("2024-01-28 00:00:00")))
    return ops.drop_superseded(inp.targets_new, published)
