"""Queries on baseline forecasts. Ensembles are reported by their summary per time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallycast.functions.timing import day
from tallycast.operators import baselines as ops
from tallycast.operators import targets as target_ops
from tallycast.plans.driver_queries import interpolated
from tallycast.plans.registry import query
from tallycast.plans.sqltext import drawn_index, inverse_normal, uniform
from tallycast.plans.target_queries import AIR

TODAY = "2001-07-10"

_CLIM = """SELECT CAST(extract(doy FROM datetime) AS INTEGER) AS doy, site_id, variable, avg(observation) AS mean,
 stddev_samp(observation) AS sd FROM history {where} GROUP BY extract(doy FROM datetime), site_id, variable"""


def _window_sql(ahead: int) -> str:
    return f"""SELECT c.site_id, c.variable, d.datetime, c.mean, c.sd FROM ({_CLIM.format(where='')}) c JOIN (
      SELECT unnest(range(TIMESTAMP '{TODAY} 00:00:00' + INTERVAL 1 DAY, TIMESTAMP '{TODAY} 00:00:00' + INTERVAL {ahead + 1} DAY,
      INTERVAL 1 DAY)) AS datetime) d ON extract(doy FROM d.datetime) = c.doy"""


def _forecast_sql(rows: str) -> str:
    head = f"""SELECT 'climatology' AS model_id, datetime, TIMESTAMP '{TODAY} 00:00:00' AS reference_datetime, site_id,
               'normal' AS family"""
    return f"""WITH w AS (SELECT *, quantile_cont(sd, 0.5) OVER (PARTITION BY site_id, variable) AS sigma FROM ({rows}) r)
      {head}, 'mu' AS parameter, variable, mean AS prediction FROM w
      UNION ALL {head}, 'sigma', variable, sigma FROM w"""


_COUNTED = "SELECT *, count(*) OVER s AS n, count(mean) OVER s AS k FROM ({rows}) q WINDOW s AS (PARTITION BY site_id, variable)"


@query("doy_climatology", "history", _CLIM.format(where="WHERE extract(year FROM datetime) < 2001"), "mean sd")
def _(inp):
    return ops.doy_climatology(inp.history, before_year=2001)


@query("doy_climatology_all_years", "history", _CLIM.format(where=""), "mean sd")
def _(inp):
    return ops.doy_climatology(inp.history)


@query(
    "climatology_forecast",
    "history",
    _forecast_sql(f"SELECT * FROM ({_COUNTED.format(rows=_window_sql(35))}) c WHERE n = k AND n >= 2"),
    "prediction",
)
def _(inp):
    return ops.climatology_forecast(ops.doy_climatology(inp.history), TODAY, "drop_series")


@query(
    "climatology_forecast_drop_rows",
    "history",
    _forecast_sql(f"SELECT * FROM ({_COUNTED.format(rows=f'SELECT * FROM ({_window_sql(35)}) z WHERE mean IS NOT NULL')}) c WHERE n >= 2"),
    "prediction",
)
def _(inp):
    return ops.climatology_forecast(ops.doy_climatology(inp.history), TODAY, "drop_rows")


@query(
    "climatology_forecast_interpolate",
    "history",
    _forecast_sql(
        interpolated(
            f"SELECT site_id, variable, datetime, mean, sd FROM ({_COUNTED.format(rows=_window_sql(36))}) c WHERE k > 2",
            "site_id, variable",
            "datetime",
            "mean",
        )
    ),
    "prediction",
)
def _(inp):
    return ops.climatology_forecast(ops.doy_climatology(inp.history), TODAY, "interpolate")


_ACTIVE_DAY = "2001-12-01"
_P1H = ["PM2.5_P1H", "PM10_P1H", "O3", "NO2_P1H"]
_P1D = ["PM2.5_P1D", "PM10_P1D"]


def _active_sql(variables: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in variables)
    return f"""SELECT DISTINCT site_id FROM coverage WHERE active AND variable IN ({listed})
      AND (extract(doy FROM start_date) < extract(doy FROM TIMESTAMP '{_ACTIVE_DAY} 00:00:00')
           OR extract(year FROM start_date) < extract(year FROM TIMESTAMP '{_ACTIVE_DAY} 00:00:00') - 1)"""


def _air(inp):
    return target_ops.normalize_air_samples(inp.air_raw)


def _active(inp, variables):
    coverage = target_ops.site_coverage(_air(inp), day(_ACTIVE_DAY))
    return ops.active_sites(coverage, day(_ACTIVE_DAY), variables)


@query("active_sites", "air_raw", f"WITH {AIR} {_active_sql(_P1H)}")
def _(inp):
    return _active(inp, _P1H)


def _window_stats_sql(slot: str, name: str, duration: str, variables: list[str], step: str) -> str:
    listed = ", ".join(f"'{v}'" for v in variables)
    return f"""WITH {AIR}, slots AS (SELECT DISTINCT {slot} AS slot FROM (SELECT unnest(range(TIMESTAMP '2001-11-04 00:00:00',
        TIMESTAMP '2001-12-09 00:00:01', INTERVAL 1 {step})) AS datetime) r)
      SELECT site_id, variable, {name}, avg(observation) AS mean, stddev_samp(observation) AS sd
      FROM (SELECT *, {slot} AS slot FROM longest) l JOIN slots USING (slot)
      WHERE duration = '{duration}' AND variable IN ({listed}) AND site_id IN ({_active_sql(variables)})
      GROUP BY site_id, variable, slot"""


@query(
    "hourly_climatology",
    "air_raw",
    _window_stats_sql(
        "extract(doy FROM datetime) * 24 + extract(hour FROM datetime)", "slot / 24.0::DOUBLE AS doy", "PT1H", _P1H, "HOUR"
    ),
    "mean sd doy",
)
def _(inp):
    return ops.hourly_climatology(target_ops.air_targets(inp.air_raw, "demo"), _active(inp, _P1H), "2001-11-04", _P1H)


@query(
    "daily_climatology",
    "air_raw",
    _window_stats_sql("extract(doy FROM datetime)", "CAST(slot AS INTEGER) AS doy", "P1D", _P1D, "DAY"),
    "mean sd",
)
def _(inp):
    return ops.daily_climatology(target_ops.air_targets(inp.air_raw, "demo"), _active(inp, _P1D), "2001-11-04", _P1D)


_WEEKLY = f"""
WITH s AS (SELECT site_id, CAST(extract(week FROM datetime) AS INTEGER) AS iso_week, avg(observation) AS mean,
                  stddev_samp(observation) AS sd FROM history GROUP BY site_id, extract(week FROM datetime)),
f AS (SELECT site_id, CAST(unnest(range(1, 45)) AS INTEGER) AS iso_week FROM (SELECT DISTINCT site_id FROM history) d),
r AS (SELECT f.site_id, f.iso_week, s.mean, s.sd FROM f LEFT JOIN s ON s.site_id = f.site_id AND s.iso_week = f.iso_week),
i AS ({interpolated('SELECT * FROM r', 'site_id', 'iso_week', 'mean')}),
a AS (SELECT * REPLACE (coalesce(sd, avg(sd) OVER (PARTITION BY site_id)) AS sd) FROM i),
b AS (SELECT * REPLACE (CASE WHEN sd = 0 THEN avg(sd) OVER (PARTITION BY site_id) ELSE sd END AS sd) FROM a)
SELECT * FROM b"""


@query("week_climatology", "history", _WEEKLY, "mean sd")
def _(inp):
    return ops.week_climatology(inp.history)


#: Takes binary fractions off the ties of decimal rounding.
_OFF = 1e-9


def _summary(df, by):
    p = F.col("prediction")
    return df.groupBy(*by).agg(F.count(p).alias("n"), F.sum(p).alias("total"), (F.min(p) + _OFF).alias("low"), (F.max(p) + _OFF).alias("high"))


_SUMMARY = "count(prediction) AS n, sum(prediction) AS total, min(prediction) + 1e-9 AS low, max(prediction) + 1e-9 AS high"


@query(
    "lognormal_ensemble",
    "history",
    f"""SELECT site_id, iso_week, {_SUMMARY} FROM (
          SELECT site_id, iso_week, exp(ln(mean + 1) - s2 / 2 + sqrt(s2) * {inverse_normal('u')}) AS prediction FROM (
            SELECT *, ln(1 + sd * sd / ((mean + 1) * (mean + 1))) AS s2, {uniform('site_id', 'iso_week', 'parameter')} AS u FROM (
              SELECT *, unnest(range(1, 501)) AS parameter FROM ({_WEEKLY}) w WHERE iso_week BETWEEN 20 AND 29) p) d) e
        GROUP BY site_id, iso_week""",
    "total low high",
)
def _(inp):
    weekly = ops.week_climatology(inp.history, weeks=list(range(20, 30)))
    return _summary(ops.lognormal_ensemble(weekly, 500), ["site_id", "iso_week"])


_FORECAST_DAY = "2024-02-01"
_LAST = """SELECT site_id, variable, max(datetime) AS d, arg_max(observation, datetime) AS last FROM targets
 WHERE observation IS NOT NULL GROUP BY site_id, variable"""


@query(
    "persistence_path",
    "targets",
    f"""SELECT site_id, variable, unnest(range(greatest(d, TIMESTAMP '{_FORECAST_DAY} 00:00:00') + INTERVAL 1 DAY,
              TIMESTAMP '{_FORECAST_DAY} 00:00:00' + INTERVAL 35 DAY, INTERVAL 1 DAY)) AS datetime, last AS prediction
        FROM ({_LAST}) l""",
)
def _(inp):
    return ops.persistence_path(inp.targets, _FORECAST_DAY)


def _walks_sql(value: str, back: str) -> str:
    """Random walks with drawn steps: changes between successive days, numbered in their series and fetched by number."""
    pick = drawn_index("size", "p.site_id", "p.variable", "parameter", "step")
    return f"""
WITH k AS (SELECT site_id, variable, CAST(datetime AS DATE) AS d, {value} AS y FROM targets WHERE observation IS NOT NULL),
s AS (SELECT *, lag(d) OVER o AS d0, lag(y) OVER o AS y0 FROM k WINDOW o AS (PARTITION BY site_id, variable ORDER BY d)),
c AS (SELECT site_id, variable, y - y0 AS change, row_number() OVER (PARTITION BY site_id, variable ORDER BY d) AS pos FROM s WHERE d - d0 = 1),
z AS (SELECT site_id, variable, max(pos) AS size, avg(change) AS centre FROM c GROUP BY site_id, variable),
l AS (SELECT site_id, variable, max(d) + 1 AS start, arg_max(y, d) AS last FROM k GROUP BY site_id, variable),
p AS (SELECT *, unnest(range(1, h + 1)) AS step FROM (
        SELECT l.*, z.size, z.centre, date_diff('day', start, DATE '{_FORECAST_DAY}') + 35 AS h, unnest(range(1, 201)) AS parameter
        FROM l JOIN z ON l.site_id = z.site_id AND l.variable = z.variable) q WHERE h > 0),
w AS (SELECT p.*, c.change FROM p JOIN c ON c.site_id = p.site_id AND c.variable = p.variable AND c.pos = {pick}),
v AS (SELECT *, last + sum(change - centre) OVER (PARTITION BY site_id, variable, parameter ORDER BY step) AS level FROM w)
SELECT site_id, variable, CAST(start + CAST(step - 1 AS INTEGER) AS TIMESTAMP) AS datetime, {back} AS prediction FROM v
WHERE start + CAST(step - 1 AS INTEGER) > DATE '{_FORECAST_DAY}'"""


@query(
    "persistence_rw",
    "targets",
    f"SELECT site_id, variable, datetime, {_SUMMARY} FROM ({_walks_sql('observation', 'level')}) r GROUP BY site_id, variable, datetime",
    "total low high",
)
def _(inp):
    return _summary(ops.persistence_rw(inp.targets, _FORECAST_DAY), ["site_id", "variable", "datetime"])


_CLICKS = "ln(1 + CASE WHEN variable = 'click' AND observation = 0 THEN 1e-5 ELSE observation END)"


@query(
    "persistence_rw_log1p",
    "targets",
    f"""SELECT site_id, variable, datetime, n, ln(total + n) AS total, low, ln(1 + high) AS high FROM (
          SELECT site_id, variable, datetime, {_SUMMARY} FROM ({_walks_sql(_CLICKS, 'exp(level) - 1')}) r
          GROUP BY site_id, variable, datetime) s""",
    "total low high",
)
def _(inp):
    # walks on this scale reach far up, so that end is compared on it
    walks = ops.persistence_rw(inp.targets, _FORECAST_DAY, transform="log1p", floor_zeros={"click": 1e-5})
    told = _summary(walks, ["site_id", "variable", "datetime"])
    return told.withColumns({"total": F.ln(F.col("total") + F.col("n")), "high": F.log1p("high")})


@query(
    "mean_forecast",
    "history",
    f"""WITH y AS (SELECT site_id, variable, ln(1 + observation) AS y,
             row_number() OVER (PARTITION BY site_id, variable ORDER BY datetime) AS pos FROM history WHERE observation > -1),
        z AS (SELECT site_id, variable, max(pos) AS size, avg(y) AS m FROM y GROUP BY site_id, variable),
        p AS (SELECT *, unnest(range(1, 53)) AS week FROM (SELECT *, unnest(range(1, 501)) AS parameter FROM z) q),
        d AS (SELECT p.site_id, p.variable, CAST(date_trunc('week', DATE '2001-11-10') + INTERVAL 7 DAY * week AS TIMESTAMP) AS datetime,
                     exp(m + (y - m)) - 1 AS prediction
              FROM p JOIN y ON y.site_id = p.site_id AND y.variable = p.variable
                AND y.pos = {drawn_index('size', 'p.site_id', 'p.variable', 'parameter', 'week')})
        SELECT site_id, variable, datetime, {_SUMMARY} FROM d GROUP BY site_id, variable, datetime""",
    "total low high",
)
def _(inp):
    return _summary(ops.mean_forecast(inp.history, "2001-11-10"), ["site_id", "variable", "datetime"])


_HALF = "(extract(hour FROM datetime) + extract(minute FROM datetime) / 60.0::DOUBLE)"
_MONTH = f"""SELECT h.*, {_HALF} AS tod FROM halfhourly h JOIN (SELECT site_id, variable, max(datetime) AS l FROM halfhourly
  GROUP BY site_id, variable) m ON m.site_id = h.site_id AND m.variable = h.variable
  WHERE h.observation IS NOT NULL AND extract(month FROM h.datetime) = extract(month FROM date_trunc('day', m.l) + INTERVAL 1 DAY)"""


def _halfhourly(inp):
    # dealt out by site, by which everything below groups: its tasks follow the size of the input
    return inp.halfhourly.repartition(inp.tasks("halfhourly"), "site_id")


@query(
    "diurnal_cycle",
    "halfhourly",
    f"SELECT site_id, variable, tod, avg(observation) AS mean, count(*) AS n FROM ({_MONTH}) q GROUP BY site_id, variable, tod",
    "mean",
)
def _(inp):
    return ops.diurnal_cycle(_halfhourly(inp))


_WINDOWS = f"""h AS ({_MONTH}), s AS (SELECT site_id, variable, count(*) AS total, unnest(range(0, 48)) / 2.0::DOUBLE AS slot FROM h
             GROUP BY site_id, variable),
        w AS (SELECT s.*, unnest(range(0, 50)) * 0.5::DOUBLE + 0.25::DOUBLE AS win FROM s),
        c AS (SELECT w.site_id, w.variable, w.slot, w.win, w.total, count(*) AS n FROM w JOIN h ON h.site_id = w.site_id
              AND h.variable = w.variable AND abs(h.tod - w.slot) < w.win GROUP BY ALL),
        m AS (SELECT site_id, variable, slot, min(win) AS win, arg_min(n, win) AS n FROM c WHERE n >= least(10, total)
              GROUP BY site_id, variable, slot)"""


@query(
    "diurnal_windows",
    "halfhourly",
    f"WITH {_WINDOWS} SELECT site_id, variable, slot, win AS window, n AS size FROM m",
)
def _(inp):
    rows = ops.diurnal_windows(_halfhourly(inp))
    return rows.select("site_id", "variable", "slot", "window", F.col("_size").alias("size"))


@query(
    "diurnal_resample",
    "halfhourly",
    f"""WITH {_WINDOWS},
        o AS (SELECT *, row_number() OVER (PARTITION BY site_id, variable ORDER BY tod, datetime) AS pos FROM h),
        f AS (SELECT m.*, (SELECT count(*) FROM h WHERE h.site_id = m.site_id AND h.variable = m.variable AND h.tod <= m.slot - m.win) AS skip,
                     unnest(range(0, 11)) AS day FROM m),
        p AS (SELECT *, unnest(range(1, 201)) AS parameter FROM f WHERE day < 10 OR slot = 0),
        d AS (SELECT p.site_id, p.variable, CAST(DATE '{_FORECAST_DAY}' + CAST(day AS INTEGER) AS TIMESTAMP) AS date, o.observation AS prediction
              FROM p JOIN o ON o.site_id = p.site_id AND o.variable = p.variable
                AND o.pos = skip + {drawn_index('n', 'p.site_id', 'p.variable', 'day', 'CAST(slot * 60 AS INTEGER)', 'parameter')})
        SELECT site_id, variable, date, {_SUMMARY} FROM d GROUP BY site_id, variable, date""",
    "total low high",
)
def _(inp):
    draws = ops.diurnal_resample(_halfhourly(inp), _FORECAST_DAY)
    return _summary(draws, ["site_id", "variable", F.to_date("datetime").alias("date")])


@query("local_level_forecast", "targets")
def _(inp):
    paths = ops.local_level_forecast(inp.targets, _FORECAST_DAY, sd_obs=5.0, bounds=(0.0, 1000.0))
    return _summary(paths, ["site_id", "variable", "datetime"])


@query(
    "fixed_quantile_table",
    "targets",
    "SELECT variable, quantile_cont(observation, 0.75) AS quantile FROM targets GROUP BY variable",
    "quantile",
)
def _(inp):
    return ops.fixed_quantile_table(inp.targets)
