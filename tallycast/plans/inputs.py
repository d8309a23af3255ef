"""Operator inputs derived from the benchmark tables by SQL that both engines run.

Values are kept to multiples of 1/64 or to integers, so sums and means do not depend on the order of addition.

Each input is a query template. ``{ts}`` and ``{text}`` name the timestamp and string types of the engine and
``each`` / ``each_of`` write its row generator; everything else is common SQL with integers and ``%`` only. All
inputs grow with the tables they read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from tallycast.schema import SUBMISSION_COLUMNS
from tallycast.sources.tables import stored_bytes

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


#: Seed rows are dealt out to this many tasks at least, and to one for every so many bytes of the tables they are from.
SPREAD, SPREAD_BYTES = 16, 1 << 18


@dataclass(frozen=True)
class Dialect:
    ts: str
    text: str
    spark: bool
    tasks: int = SPREAD

    def each(self, name: str, low: int, high: int) -> str:
        if self.spark:
            return f"explode(sequence({low}, {high})) AS {name}"
        return f"unnest(range({low}, {high + 1})) AS {name}"

    def each_of(self, name: str, values: list) -> str:
        items = ", ".join(repr(v) for v in values)
        return f"explode(array({items})) AS {name}" if self.spark else f"unnest([{items}]) AS {name}"

    def array(self, values: list) -> str:
        items = ", ".join(repr(v) for v in values)
        return f"array({items})" if self.spark else f"[{items}]"

    def iso(self, expr: str) -> str:
        """A date as text."""
        return f"date_format({expr}, 'yyyy-MM-dd')" if self.spark else f"strftime({expr}, '%Y-%m-%d')"

    @property
    def spread(self) -> str:
        """Spark: deal small seed rows out to the tasks before they are multiplied."""
        return f"/*+ REPARTITION({self.tasks}) */ " if self.spark else ""

    @property
    def by_target(self) -> str:
        """Spark: deal rows out by what names their target before they are multiplied (further).

        Joins and groups by a target's key then find its rows in one task, and multiplied rows are not shuffled.
        """
        return f"/*+ REPARTITION({self.tasks}, site_id, datetime, variable) */ " if self.spark else ""

    @property
    def merge(self) -> str:
        """Spark: members are made from few rows, which lets it take them for small and broadcast them."""
        return "/*+ MERGE(f) */ " if self.spark else ""

    def date(self, expr: str) -> str:
        return f"CAST({expr} AS DATE)"


SPARK = Dialect("TIMESTAMP_NTZ", "STRING", True)
DUCK = Dialect("TIMESTAMP", "VARCHAR", False)


def _targets(d: Dialect) -> str:
    return f"""
SELECT 'demo' AS project_id, concat('S', lpad(CAST(user_id AS {d.text}), 6, '0')) AS site_id, day AS datetime,
       'P1D' AS duration, event_type AS variable,
       CASE WHEN (user_id + extract(day FROM day)) % 11 = 0 THEN NULL
            ELSE floor(CAST(sum(cents) * 16 AS DOUBLE) / (25 * count(*))) / 64 END AS observation
FROM (SELECT user_id, CAST(date_trunc('day', ts) AS {d.ts}) AS day, event_type,
             CAST(round(value * 100) AS BIGINT) AS cents FROM events) e
GROUP BY user_id, day, event_type"""


def _targets_new(d: Dialect) -> str:
    """A second delivery: the later half revised, plus five more days of every series."""
    return f"""
SELECT project_id, site_id, datetime, duration, variable, observation + CAST(0.125 AS DOUBLE) AS observation
FROM targets WHERE datetime >= TIMESTAMP '2024-01-16 00:00:00'
UNION ALL
SELECT project_id, site_id, CAST(datetime + INTERVAL 30 DAY AS {d.ts}) AS datetime, duration, variable, observation
FROM targets WHERE datetime < TIMESTAMP '2024-01-06 00:00:00'"""


def _forecasts(d: Dialect) -> str:
    return f"""
SELECT project_id, concat('m', CAST(m AS {d.text})) AS model_id, site_id, datetime,
       CAST(datetime - INTERVAL 1 DAY * h AS {d.ts}) AS reference_datetime, duration, variable,
       CASE WHEN m = 2 THEN 'ensemble' ELSE 'sample' END AS family, CAST(e AS {d.text}) AS parameter,
       CAST(50 + (m - 1) * 5 + (e - 3) * (1 + h % 5)
            + ((extract(day FROM datetime) * 3 + e * 5 + m) % 7 - 3) * 2 AS DOUBLE) AS prediction,
       CAST(datetime - INTERVAL 1 DAY * (h - 1) AS {d.ts}) AS pub_datetime
FROM (SELECT c.*, {d.each('e', 1, 5)} FROM (
        SELECT b.*, {d.each_of('h', [1, 35, 36])} FROM (SELECT {d.by_target}* FROM (
          SELECT t.*, {d.each('m', 0, 2)} FROM (SELECT {d.spread}* FROM targets) t) m) b) c) x"""


def _joined(d: Dialect) -> str:
    """Forecast members beside their observation."""
    keys = "project_id, site_id, datetime, duration, variable"
    return f"""
SELECT {d.merge}{', '.join('f.' + k for k in keys.split(', '))}, f.model_id, f.reference_datetime, f.family, f.parameter,
       f.prediction, f.pub_datetime, t.observation
FROM forecasts f JOIN targets t ON {' AND '.join(f'f.{k} = t.{k}' for k in keys.split(', '))}
WHERE t.observation IS NOT NULL"""


def _joined_parametric(d: Dialect) -> str:
    """Two parameter rows per family and observation; observations moved into the support of bounded families."""
    return f"""
SELECT project_id, site_id, datetime, duration, variable, 'param' AS model_id,
       CAST(datetime - INTERVAL 1 DAY AS {d.ts}) AS reference_datetime, datetime AS pub_datetime, family,
       CASE family WHEN 'normal' THEN CASE WHEN k = 1 THEN 'mu' ELSE 'sigma' END
                   WHEN 'lognormal' THEN CASE WHEN k = 1 THEN 'mu' ELSE 'sigma' END
                   WHEN 'logistic' THEN CASE WHEN k = 1 THEN 'location' ELSE 'scale' END
                   WHEN 'exponential' THEN CASE WHEN k = 1 THEN 'rate' ELSE 'unused' END
                   WHEN 'uniform' THEN CASE WHEN k = 1 THEN 'min' ELSE 'max' END
                   WHEN 'bernoulli' THEN CASE WHEN k = 1 THEN 'prob' ELSE 'unused' END
                   WHEN 'poisson' THEN CASE WHEN k = 1 THEN 'lambda' ELSE 'unused' END
                   WHEN 'gamma' THEN CASE WHEN k = 1 THEN 'shape' ELSE 'rate' END
                   ELSE CASE WHEN k = 1 THEN 'shape1' ELSE 'shape2' END END AS parameter,
       CAST(CASE family
            WHEN 'normal' THEN CASE WHEN k = 1 THEN 40 + s % 20 + dd ELSE 5 + dd % 7 END
            WHEN 'lognormal' THEN CASE WHEN k = 1 THEN 3 + (dd % 5) * 0.25 ELSE 0.5 + (s % 4) * 0.125 END
            WHEN 'logistic' THEN CASE WHEN k = 1 THEN 30 + s % 25 + dd ELSE 4 + dd % 5 END
            WHEN 'exponential' THEN CASE WHEN k = 1 THEN 0.015625 * (1 + dd % 9) ELSE 0 END
            WHEN 'uniform' THEN CASE WHEN k = 1 THEN 10 + s % 30 ELSE 80 + s % 30 + dd END
            WHEN 'bernoulli' THEN CASE WHEN k = 1 THEN 0.0625 * (1 + (s + dd) % 14) ELSE 0 END
            WHEN 'poisson' THEN CASE WHEN k = 1 THEN 5 + s % 40 ELSE 0 END
            WHEN 'gamma' THEN CASE WHEN k = 1 THEN 1 + dd % 4 ELSE 0.03125 * (1 + s % 5) END
            ELSE CASE WHEN k = 1 THEN 1 + dd % 4 ELSE 1 + s % 3 END END AS DOUBLE) AS prediction,
       CAST(CASE family WHEN 'bernoulli' THEN dd % 2 WHEN 'beta' THEN ((s * 7 + dd * 3) % 99 + 0.5) * 0.01
            WHEN 'poisson' THEN floor(observation) ELSE observation END AS DOUBLE) AS observation
FROM (SELECT b.*, {d.each('k', 1, 2)} FROM (
        SELECT t.*, CAST(substring(site_id, 2) AS INT) AS s, CAST(extract(day FROM datetime) AS INT) AS dd,
               {d.each_of('family', ['normal', 'lognormal', 'logistic', 'exponential', 'uniform', 'bernoulli',
                                     'poisson', 'gamma', 'beta'])}
        FROM (SELECT {d.by_target}* FROM targets) t WHERE observation IS NOT NULL) b) x"""


def _scores(d: Dialect) -> str:
    """A score table in plain arithmetic, for everything downstream of scoring."""
    return f"""
SELECT project_id, concat('m', CAST(m AS {d.text})) AS model_id, site_id, datetime,
       CAST(datetime - INTERVAL 1 DAY * h AS {d.ts}) AS reference_datetime, duration, variable, 'sample' AS family,
       CASE WHEN m = 1 THEN NULL ELSE CAST(datetime - INTERVAL 1 DAY * (h - 1) AS {d.ts}) END AS pub_datetime,
       observation, CAST(abs(observation - center) * 0.5 + h * 0.125 AS DOUBLE) AS crps,
       CAST(3 + abs(observation - center) * 0.0625 AS DOUBLE) AS logs,
       CAST(center AS DOUBLE) AS mean, CAST(center - 1 AS DOUBLE) AS median, CAST(5 + m AS DOUBLE) AS sd,
       CAST(center + 10 AS DOUBLE) AS quantile97_5, CAST(center - 10 AS DOUBLE) AS quantile02_5,
       CAST(center + 8 AS DOUBLE) AS quantile90, CAST(center - 8 AS DOUBLE) AS quantile10
FROM (SELECT c.*, 50 + (m - 1) * 5 + extract(day FROM datetime) % 7 AS center FROM (
        SELECT b.*, {d.each_of('h', [1, 4, 35, 36])} FROM (
          SELECT t.*, {d.each('m', 0, 2)} FROM (SELECT {d.by_target}* FROM targets) t
          WHERE observation IS NOT NULL) b) c) x"""


def _scores_old(d: Dialect) -> str:
    """What had been scored by mid month; some rows were stored before their observation came."""
    columns = (
        "project_id, model_id, site_id, datetime, reference_datetime, duration, variable, family, pub_datetime, "
        "CASE WHEN extract(day FROM datetime) % 5 = 0 THEN NULL ELSE observation END AS observation, crps, logs, mean, "
        "median, sd, quantile97_5, quantile02_5, quantile90, quantile10"
    )
    return f"SELECT {columns} FROM scores WHERE datetime < TIMESTAMP '2024-01-16 00:00:00'"


def _scores_durations(d: Dialect) -> str:
    """Scores of daily forecasts, and of weekly and hourly ones of the same models and variables."""
    return f"""
SELECT * FROM scores
UNION ALL
SELECT project_id, model_id, site_id, datetime, CAST(reference_datetime - INTERVAL 1 DAY AS {d.ts}) AS reference_datetime,
       CASE WHEN extract(day FROM datetime) % 7 = 1 THEN 'P1W' ELSE 'PT1H' END AS duration, variable, family, pub_datetime,
       observation, crps * 2 + 1 AS crps, logs, mean + 1 AS mean, median, sd, quantile97_5, quantile02_5, quantile90, quantile10
FROM scores WHERE extract(day FROM datetime) % 7 < 2"""


def _sites(d: Dialect) -> str:
    return """
SELECT site_id AS field_site_id, CAST(20 + s % 40 AS DOUBLE) AS latitude, CAST(-60 - s % 100 AS DOUBLE) AS longitude
FROM (SELECT DISTINCT site_id, CAST(substring(site_id, 2) AS INT) AS s FROM targets) x"""


def _air_raw(d: Dialect) -> str:
    """Air sensor samples with corrections; three sensors per site, times rounded so that corrections collide."""
    return f"""
SELECT lpad(CAST(l_suppkey % 50 AS {d.text}), 2, '0') AS state_code,
       lpad(CAST(l_suppkey % 17 AS {d.text}), 3, '0') AS county_code,
       lpad(CAST(l_suppkey AS {d.text}), 6, '0') AS site_number,
       CASE l_linenumber % 4 WHEN 0 THEN 'PM2.5 - Local Conditions' WHEN 1 THEN 'PM10 Total 0-10um STP'
            WHEN 2 THEN 'Ozone' ELSE 'Nitrogen dioxide (NO2)' END AS parameter,
       CAST(1 + l_partkey % 3 AS INT) AS poc, {d.iso("date_trunc('month', l_shipdate)")} AS date_gmt,
       concat(lpad(CAST(l_orderkey % 4 AS {d.text}), 2, '0'), ':00') AS time_gmt,
       {d.iso("date_trunc('month', l_shipdate)")} AS date_local,
       CASE WHEN l_orderkey % 2 = 0 THEN '1 HOUR' ELSE '24 HOUR' END AS sample_duration,
       CASE WHEN extract(year FROM l_shipdate) < 1998 THEN 'ppm' WHEN l_linenumber % 4 < 2 THEN 'ug/m3'
            ELSE 'ppb' END AS units_of_measure,
       CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_quantity END AS sample_measurement,
       {d.iso('l_shipdate + INTERVAL 1 DAY * l_linenumber')} AS date_of_last_change,
       CAST(25 + l_suppkey % 20 AS DOUBLE) AS latitude, CAST(-80 + l_suppkey % 30 AS DOUBLE) AS longitude
FROM lineitem"""


def _buoy_raw(d: Dialect) -> str:
    return """
SELECT ts AS time, user_id AS platform, CASE WHEN event_id % 70 = 3 THEN NULL ELSE CAST(40 + user_id % 5 AS DOUBLE) END AS latitude,
       CASE WHEN event_id % 50 = 0 THEN 1e20 ELSE CAST(-70 - user_id % 5 AS DOUBLE) END AS longitude,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS chlorophyll,
       CASE WHEN event_type = 'view' THEN NULL ELSE value * 0.5 END AS temperature, value * 0.25 AS turbidity
FROM events"""


def _grid(d: Dialect) -> str:
    return f"""
SELECT {d.date('l_shipdate')} AS date, CAST(30 + (l_suppkey % 25) * 0.5 AS DOUBLE) AS lat,
       CAST(-80 + (l_partkey % 25) * 0.5 AS DOUBLE) AS lon,
       CASE WHEN (l_suppkey % 25 + l_partkey % 25) % 7 = 0 THEN NULL ELSE max(l_quantity) END AS value
FROM lineitem GROUP BY 1, l_suppkey % 25, l_partkey % 25"""


def _paired(d: Dialect) -> str:
    """Two measuring methods of one quantity, several sites and hours per day."""
    return f"""
SELECT 'demo' AS project_id, concat('S', lpad(CAST(l_suppkey AS {d.text}), 6, '0')) AS site_id,
       CAST(l_shipdate AS {d.ts}) AS datetime, 'P1D' AS duration,
       CASE WHEN l_linenumber % 2 = 0 THEN 'chla_probe' ELSE 'chla_satellite' END AS variable,
       max(CASE WHEN l_orderkey % 40 = 0 THEN -l_quantity WHEN l_orderkey % 41 = 0 THEN CAST(0.0005 AS DOUBLE)
                ELSE l_quantity END) AS observation
FROM lineitem GROUP BY l_suppkey, l_shipdate, l_linenumber % 2"""


def _cases(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {d.date('o_orderdate')} END AS onset_date,
       {d.date('o_orderdate + INTERVAL 7 DAY')} AS notified_date,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 1975 + c_nationkey END AS birth_year,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE concat('35', lpad(CAST(c_custkey % 9000 AS {d.text}), 4, '0')) END
           AS place
FROM orders JOIN customer ON o_custkey = c_custkey"""


def _camera_daily(d: Dialect) -> str:
    return f"""
SELECT concat('S', lpad(CAST(user_id AS {d.text}), 6, '0')) AS site_id,
       CAST(date_trunc('day', ts) AS {d.ts}) AS datetime, max(value) AS gcc_90, min(value) AS rcc_90
FROM events GROUP BY user_id, date_trunc('day', ts)"""


def _sensor_eav(d: Dialect) -> str:
    """Sensor terms in entity-attribute-value form: a measurement, its depth and two quality flags per reading."""
    return f"""
SELECT concat('L', lpad(CAST(user_id AS {d.text}), 6, '0')) AS siteName, termName,
       CASE event_id % 4 WHEN 0 THEN '101' WHEN 1 THEN '102' WHEN 2 THEN '103' ELSE '111' END AS horizontalIndex,
       CAST(501 + event_id % 3 AS {d.text}) AS verticalIndex,
       CASE WHEN event_id % 5 = 0 THEN '001' ELSE '030' END AS temporalIndex,
       CAST(ts AS {d.ts}) AS startDate,
       CASE WHEN termName IN ('dissolvedOxygen', 'chlorophyll') THEN value
            WHEN termName = 'waterTemp' AND event_id % 3 > 0 THEN floor(value * 8) / CAST(64 AS DOUBLE)
            WHEN termName = 'sensorDepth' THEN (event_id % 15) * 0.125 END AS doubleValue,
       CAST(CASE WHEN termName = 'oxygenQF' THEN CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END
                 WHEN termName = 'tempQF' THEN CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END
                 WHEN termName = 'chlorophyllQF' THEN CASE WHEN event_id % 6 = 0 THEN 1 ELSE 0 END
                 WHEN termName = 'waterTemp' AND event_id % 3 = 0 THEN floor(value * 0.125) END AS BIGINT) AS intValue
FROM (SELECT e.*, {d.each_of('termName', ['dissolvedOxygen', 'chlorophyll', 'sensorDepth', 'oxygenQF',
                                          'chlorophyllQF', 'waterTemp', 'tempQF', 'batteryVoltage'])}
      FROM events e) x"""


def _sensor_depths(d: Dialect) -> str:
    """Depth of each sensor position; one position per site is below one metre."""
    return f"""
SELECT siteName, CAST(501 + k AS {d.text}) AS verticalIndex, CAST(0.25 + k * 0.5 AS DOUBLE) AS thermistorDepth
FROM (SELECT s.*, {d.each('k', 0, 2)} FROM (
        SELECT DISTINCT concat('L', lpad(CAST(user_id AS {d.text}), 6, '0')) AS siteName FROM events) s) x"""


def _drivers_raw(d: Dialect) -> str:
    """A weather forecast in three-hour steps, two members per site and issue day."""
    return f"""
SELECT concat('S', lpad(CAST(user_id AS {d.text}), 6, '0')) AS site_id, 'ensemble' AS family,
       concat('gep0', CAST(g AS {d.text})) AS ensemble, day AS reference_datetime,
       CAST(day + INTERVAL 1 HOUR * (3 * k) AS {d.ts}) AS datetime, CAST(3 * k AS DOUBLE) AS horizon, variable,
       CASE WHEN (user_id + k) % 9 = 0 AND k > 0 THEN NULL ELSE
         CAST(CASE variable WHEN 'PRES' THEN 100000 + user_id % 90 + k * 10 WHEN 'RH' THEN 40 + (user_id + k * 3) % 50
              WHEN 'TMP' THEN 5 + g + (k * k) % 11 WHEN 'UGRD' THEN k - 4 + g WHEN 'VGRD' THEN 3 - k
              WHEN 'APCP' THEN (user_id + k) % 4 WHEN 'DSWRF' THEN (k % 8) * 60 + g ELSE 250 + k * 5 END AS DOUBLE)
       END AS prediction
FROM (SELECT c.*, {d.each_of('variable', ['PRES', 'RH', 'TMP', 'UGRD', 'VGRD', 'APCP', 'DSWRF', 'DLWRF'])} FROM (
        SELECT b.*, {d.each('k', 0, 10)} FROM (
          SELECT a.*, {d.each('g', 1, 2)} FROM (
            SELECT {d.spread}* FROM (
              SELECT DISTINCT user_id, CAST(date_trunc('day', ts) AS {d.ts}) AS day FROM events) q) a) b) c) x"""


def _pseudo_raw(d: Dialect) -> str:
    """Short forecasts chained into a pseudo-observation record: steps 003 and 006 of every six-hour cycle.

    Every fourth row carries a wrong valid time, to be repaired.
    """
    return f"""
SELECT site_id, family, ensemble, reference_datetime,
       CAST(CASE WHEN (c + k + extract(day FROM reference_datetime)) % 4 = 0 THEN reference_datetime
            ELSE reference_datetime + INTERVAL 1 HOUR * (6 * c + 3 * k) END AS {d.ts}) AS datetime,
       concat('00', CAST(3 * k AS {d.text})) AS horizon, lpad(CAST(6 * c AS {d.text}), 2, '0') AS cycle, variable,
       CAST(CASE variable WHEN 'PRES' THEN 100000 + s % 90 + c * 10 WHEN 'RH' THEN 40 + (s + k * 3 + c) % 50
            WHEN 'TMP' THEN 5 + (c * k) % 11 WHEN 'UGRD' THEN c - 2 WHEN 'VGRD' THEN 3 - c
            WHEN 'APCP' THEN (s + c) % 4 WHEN 'DSWRF' THEN c * 120 + k ELSE 250 + c * 5 END AS DOUBLE) AS prediction
FROM (SELECT t3.*, {d.each_of('variable', ['PRES', 'RH', 'TMP', 'UGRD', 'VGRD', 'APCP', 'DSWRF', 'DLWRF'])} FROM (
        SELECT t2.*, {d.each('k', 1, 2)} FROM (
          SELECT t1.*, {d.each('c', 0, 3)} FROM (
            SELECT CASE WHEN user_id % 2 = 0 THEN concat('S', lpad(CAST(user_id AS {d.text}), 6, '0'))
                        ELSE lpad(CAST(user_id AS {d.text}), 6, '0') END AS site_id,
                   user_id AS s, 'ensemble' AS family, 'gep01' AS ensemble, day AS reference_datetime
            FROM (SELECT {d.spread}* FROM (
              SELECT DISTINCT user_id, CAST(date_trunc('day', ts) AS {d.ts}) AS day FROM events) p) q) t1) t2) t3) x"""


def _history(d: Dialect) -> str:
    """Several years of daily observations per site."""
    return f"""
SELECT 'demo' AS project_id, concat('S', lpad(CAST(l_suppkey AS {d.text}), 6, '0')) AS site_id,
       CAST(l_shipdate AS {d.ts}) AS datetime, 'P1D' AS duration, 'temperature' AS variable,
       CASE WHEN (l_suppkey + extract(day FROM l_shipdate)) % 13 = 0 THEN NULL ELSE max(l_quantity) END AS observation
FROM lineitem GROUP BY l_suppkey, l_shipdate"""


def _halfhourly(d: Dialect) -> str:
    return f"""
SELECT concat('S', lpad(CAST(user_id AS {d.text}), 6, '0')) AS site_id,
       CAST(date_trunc('hour', ts) + INTERVAL 1 MINUTE * (CASE WHEN extract(minute FROM ts) < 30 THEN 0 ELSE 30 END)
            AS {d.ts}) AS datetime, 'nee' AS variable, max(value) AS observation
FROM events GROUP BY 1, 2"""


def _submissions(d: Dialect) -> str:
    """Rows of submitted files as text, one file per model and issue date; file faults follow the file's number.

    ``columns`` lists what a file has; columns it lacks are NULL.
    """
    lacking = {
        "u % 37 = 5": ["project_id"],
        "u % 31 = 6": ["site_id"],
        "u % 29 = 7": ["duration"],
        "u % 27 = 8": ["family", "parameter"],
        "u % 25 = 9": ["prediction"],
        "u % 23 = 10": ["reference_datetime"],
    }
    whens = [f"WHEN {k} THEN {d.array([c for c in SUBMISSION_COLUMNS if c not in v])}" for k, v in lacking.items()]
    whens.append(f"WHEN u % 21 = 11 THEN {d.array([*SUBMISSION_COLUMNS, 'ensemble'])}")
    columns = f"CASE {' '.join(whens)} ELSE {d.array(SUBMISSION_COLUMNS)} END"
    has = "array_contains" if d.spark else "list_contains"
    blank = ", ".join(f"CASE WHEN {has}(columns, '{c}') THEN {c} END AS {c}" for c in SUBMISSION_COLUMNS)
    return f"""
SELECT file, columns, {blank} FROM (
SELECT {columns} AS columns,
       concat(CASE WHEN u % 3 = 0 THEN 'aquatics' WHEN u % 3 = 1 THEN 'ticks' ELSE 'other' END, '-',
              {d.iso('ref')}, '-team', CAST(u AS {d.text}), CASE WHEN u % 17 = 5 THEN '.xlsx'
              WHEN u % 2 = 0 THEN '.csv' ELSE '.csv.gz' END) AS file,
       'demo' AS project_id, CASE WHEN u % 11 = 0 THEN NULL WHEN u % 13 = 0 AND k > 2
              THEN 'another' ELSE concat('team', CAST(u AS {d.text})) END AS model_id,
       concat({d.iso('ref + INTERVAL 1 DAY * (k * CASE WHEN u % 19 = 0 THEN 20 ELSE 1 END)')},
              CASE WHEN u % 23 = 7 AND k = 1 THEN 'x' ELSE ' 00:00:00' END) AS datetime,
       concat({d.iso('ref')}, ' 00:00:00') AS reference_datetime,
       CASE WHEN u % 29 = 2 AND k = 2 THEN 'PT1H' WHEN u % 7 = 3 THEN NULL ELSE 'P1D' END AS duration,
       concat('S', lpad(CAST(u AS {d.text}), 6, '0')) AS site_id,
       CASE WHEN u % 31 = 4 AND k = 3 THEN 'normal' ELSE 'ensemble' END AS family,
       CAST(e AS {d.text}) AS parameter, event_type AS variable,
       CASE WHEN e = 2 AND u % 5 = 1 THEN 'NA' ELSE CAST(CAST(10 + k * 2 + e AS DOUBLE) AS {d.text}) END AS prediction
FROM (SELECT b.*, {d.each('e', 1, 3)} FROM (
        SELECT a.*, {d.each('k', 0, 4)} FROM (
          SELECT {d.spread}* FROM (
            SELECT DISTINCT user_id AS u, event_type, CAST(date_trunc('day', ts) AS {d.ts}) AS ref FROM events) q) a) b) x) y"""


def _allowed(d: Dialect) -> str:
    """Permitted (variable, duration) pairs with their longest horizon; one event type is not permitted."""
    return """
SELECT event_type AS variable, 'P1D' AS duration, 35 AS max_horizon FROM events
WHERE event_type <> 'signup' GROUP BY event_type
UNION ALL SELECT event_type, 'PT1H', 60 FROM events WHERE event_type <> 'signup' GROUP BY event_type"""


def _registry(d: Dialect) -> str:
    """Registration answers; a model may be registered twice, once with blanks."""
    answers = {
        "initial_conditions": ["Yes and they were estimated from data", "Yes and they were not estimated from data", "No"],
        "parameters_used": ["Yes and they are not estimated from data", "Yes and at least one is estimated from data", "No"],
        "parameters": ["Yes", "No"],
        "drivers": ["Yes", "No"],
        "process": ["Yes and the uncertainty was estimated from data", "Yes and the uncertainty was not estimated from data", "No"],
        "noise": ["Yes and the noise was estimated from data", "Yes and the noise was not estimated from data", "No"],
        "structure": ["Yes", "No"],
        "random_effects": ["Yes and the uncertainty was estimated from data", "Yes and the uncertainty was not estimated from data (uncommon)", "No"],
        "assimilation": ["Initial conditions", "Both initial conditions and parameters", "Parameter", "None"],
    }
    cases = []
    for i, (name, values) in enumerate(answers.items()):
        n = len(values) + 1
        whens = " ".join(f"WHEN {j} THEN '{v}'" for j, v in enumerate(values))
        cases.append(f"CASE (c_custkey * {i + 2} + c_nationkey) % {n} {whens} END AS {name}")
    return f"""
SELECT concat('m', CAST(c_custkey AS {d.text}), CASE WHEN c_custkey % 10 = 7 THEN '_example' ELSE '' END)
           AS model_id,
       'demo' AS project_id, c_name AS long_name,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Empirical (linear)' WHEN 'MACHINERY' THEN 'empirical'
            WHEN 'FURNITURE' THEN 'Process model' WHEN 'HOUSEHOLD' THEN NULL ELSE 'Machine learning' END AS model_type,
       concat('https://code.example/', c_name) AS repository,
       CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS is_dynamic,
       CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS uses_drivers,
       CASE WHEN c_nationkey % 4 = 0 THEN 'Kalman filter' END AS assimilation_method,
       {(',' + chr(10) + '       ').join(cases)}
FROM customer"""


def _taxonomy_sorting(d: Dialect) -> str:
    return f"""
SELECT CAST(l_orderkey AS {d.text}) AS subsampleID,
       CASE l_linenumber % 4 WHEN 0 THEN 'carabid' WHEN 1 THEN 'other carabid' WHEN 2 THEN 'common carabid'
            ELSE 'vert bycatch herp' END AS sampleType,
       CASE l_linenumber % 3 WHEN 0 THEN 'genus' ELSE 'species' END AS taxonRank,
       concat('Genus', CAST(l_suppkey AS {d.text}), ' species', CAST(l_linenumber AS {d.text}),
              CASE WHEN l_linenumber % 2 = 0 THEN ' subsp/alt name' ELSE '' END) AS scientificName,
       concat('T', CAST(l_suppkey AS {d.text})) AS taxonID,
       CASE WHEN l_linenumber % 3 = 0 THEN concat('morph', CAST(l_suppkey AS {d.text})) END AS morphospeciesID,
       'N' AS nativeStatusCode, CASE WHEN l_linenumber % 5 = 0 THEN 'damaged' END AS sampleCondition
FROM (SELECT l_orderkey, l_linenumber, max(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2) q"""


def _taxonomy_para(d: Dialect) -> str:
    return f"""
SELECT CAST(o_orderkey AS {d.text}) AS subsampleID, concat('I', CAST(o_orderkey AS {d.text})) AS individualID,
       CASE WHEN o_orderstatus = 'F' THEN 'subgenus' WHEN o_orderstatus = 'O' THEN 'species' END AS taxonRank,
       CASE WHEN o_orderstatus <> 'P' THEN concat('Para', CAST(o_custkey AS {d.text}), ' sp.') END AS scientificName,
       CASE WHEN o_orderstatus <> 'P' THEN concat('P', CAST(o_custkey AS {d.text})) END AS taxonID,
       CASE WHEN o_orderstatus = 'F' THEN concat('pm', CAST(o_custkey AS {d.text})) END AS morphospeciesID
FROM orders WHERE o_orderpriority <> '5-LOW'"""


def _taxonomy_expert(d: Dialect) -> str:
    return f"""
SELECT concat('I', CAST(o_orderkey AS {d.text})) AS individualID,
       CASE WHEN o_totalprice < 300000 THEN 'species' END AS taxonRank,
       CASE WHEN o_totalprice < 300000 THEN 'Expertus verus minor' END AS scientificName,
       CASE WHEN o_totalprice < 300000 THEN 'EXP' END AS taxonID, CAST(NULL AS {d.text}) AS morphospeciesID,
       CASE WHEN o_custkey % 3 = 0 THEN 'Carabidae' WHEN o_custkey % 3 = 1 THEN 'Silphidae' END AS family,
       CASE WHEN o_custkey % 4 = 0 THEN 'I' END AS nativeStatusCode,
       CASE WHEN o_custkey % 5 = 0 THEN 'OK' END AS sampleCondition
FROM orders WHERE o_orderpriority = '1-URGENT'"""


#: name -> (template, inputs it reads)
INPUTS = {
    "targets": (_targets, []),
    "targets_new": (_targets_new, ["targets"]),
    "forecasts": (_forecasts, ["targets"]),
    "joined": (_joined, ["forecasts", "targets"]),
    "joined_parametric": (_joined_parametric, ["targets"]),
    "scores": (_scores, ["targets"]),
    "scores_old": (_scores_old, ["scores"]),
    "scores_durations": (_scores_durations, ["scores"]),
    "sites": (_sites, ["targets"]),
    "air_raw": (_air_raw, []),
    "buoy_raw": (_buoy_raw, []),
    "grid": (_grid, []),
    "paired": (_paired, []),
    "cases": (_cases, []),
    "camera_daily": (_camera_daily, []),
    "sensor_eav": (_sensor_eav, []),
    "sensor_depths": (_sensor_depths, []),
    "drivers_raw": (_drivers_raw, []),
    "pseudo_raw": (_pseudo_raw, []),
    "history": (_history, []),
    "halfhourly": (_halfhourly, []),
    "submissions": (_submissions, []),
    "allowed": (_allowed, []),
    "registry": (_registry, []),
    "taxonomy_sorting": (_taxonomy_sorting, []),
    "taxonomy_para": (_taxonomy_para, []),
    "taxonomy_expert": (_taxonomy_expert, []),
}


def closure(names: list[str]) -> list[str]:
    """The inputs and what they read, each after its own inputs."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES or name in done:
            return
        for need in INPUTS[name][1]:
            visit(need)
        done.append(name)

    for name in names:
        visit(name)
    return done


def with_clause(names: list[str], dialect: Dialect) -> list[str]:
    return [f"{name} AS ({INPUTS[name][0](dialect)})" for name in closure(names)]


class Inputs:
    """The benchmark tables and derived inputs of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name not in INPUTS:
            raise AttributeError(name)
        query = ",\n".join(with_clause([name], SPARK))
        tables = self._tables(query)
        if SPARK.spread in query or SPARK.by_target in query:
            tasks = self.tasks(name, joined=SPARK.by_target in query)
            query = ",\n".join(with_clause([name], replace(SPARK, tasks=tasks)))
        ctes = [f"{t} AS (SELECT * FROM parquet.`{self.folder}/{t}.parquet`)" for t in tables]
        return self.spark.sql(f"WITH {', '.join(ctes)}, {query} SELECT * FROM {name}")

    def _tables(self, query: str) -> list[str]:
        return [t for t in TABLES if f" {t}" in query]

    def tasks(self, name: str, joined: bool = True) -> int:
        """To how many tasks the size of its tables asks to deal an input out, whatever the session's shuffles have.

        A join shuffles again what lies in fewer parts than its own shuffles have (``joined``).
        """
        tables = self._tables(",\n".join(with_clause([name], SPARK)))
        size = sum(stored_bytes(self.spark, f"{self.folder}/{t}.parquet") for t in tables)
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions")) if joined else 0
        return max(SPREAD, parts, size // SPREAD_BYTES)
