"""Pieces of checking SQL shared by several queries."""

from __future__ import annotations

from tallycast.functions import draws
from tallycast.functions.normal import DENOMINATOR, NUMERATOR

KEYS = (
    "project_id, site_id, datetime, duration, variable, model_id, "
    "CASE WHEN family = 'ensemble' THEN 'sample' ELSE family END AS family, reference_datetime, pub_datetime"
)
GROUP = "project_id, site_id, datetime, duration, variable, model_id, family, reference_datetime, pub_datetime"


def phi(z: str) -> str:
    """The normal distribution function of a column."""

    def poly(coefficients, x):
        text = repr(coefficients[0]) + "::DOUBLE"
        for c in coefficients[1:]:
            text = f"(({text}) * {x} + {c!r}::DOUBLE)"
        return text

    a = f"abs({z})"
    near = f"exp(-{a} * {a} / 2) * {poly(NUMERATOR, a)} / {poly(DENOMINATOR, a)}"
    far = f"exp(-{a} * {a} / 2) / ({a} + 1 / ({a} + 2 / ({a} + 3 / ({a} + 4 / ({a} + 0.65::DOUBLE))))) / 2.506628274631"
    tail = f"CASE WHEN {a} > 37 THEN 0 WHEN {a} < 7.07106781186547 THEN {near} ELSE {far} END"
    return f"(CASE WHEN {z} > 0 THEN 1 - {tail} ELSE {tail} END)"


def uniform(*keys: str, seed: int = 1) -> str:
    """The draw in (0, 1) of its keys."""
    return f"((('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(keys)})), 1, {draws.DIGITS}))::BIGINT::DOUBLE + 0.5) / {draws.STEPS!r}::DOUBLE)"


def drawn_index(size: str, *keys: str) -> str:
    """The draw from 1 to ``size`` of its keys."""
    return f"(floor({uniform(*keys)} * {size})::BIGINT + 1)"


def inverse_normal(u: str) -> str:
    """The normal quantile of a column."""

    def ratio(top, bottom, x):
        def horner(coefficients):
            text = f"{coefficients[0]!r}::DOUBLE"
            for c in coefficients[1:]:
                text = f"(({text}) * {x} + {c!r}::DOUBLE)"
            return text

        return f"{horner(top)} / {horner(bottom)}"

    far = ratio(draws.TAIL_TOP, draws.TAIL_BOTTOM, f"sqrt(-2 * ln(least({u}, 1 - {u})))")
    near = f"({u} - 0.5) * " + ratio(draws.CENTRE_TOP, draws.CENTRE_BOTTOM, f"(({u} - 0.5) * ({u} - 0.5))")
    return f"(CASE WHEN {u} < {draws.TAIL} THEN {far} WHEN {u} > 1 - {draws.TAIL} THEN -({far}) ELSE {near} END)"


def pdf(z: str) -> str:
    return f"(exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()))"


#: Members of every sample forecast with their rank and group size, and the score parts that need only those.
SAMPLE_PARTS = f"""
SELECT {GROUP}, observation, count(*) AS m, avg(prediction) AS mean, stddev_samp(prediction) AS sd,
       quantile_cont(prediction, 0.5) AS median, quantile_cont(prediction, 0.975) AS quantile97_5,
       quantile_cont(prediction, 0.025) AS quantile02_5, quantile_cont(prediction, 0.95) AS quantile90,
       quantile_cont(prediction, 0.05) AS quantile10,
       quantile_cont(prediction, 0.75) - quantile_cont(prediction, 0.25) AS iqr,
       2 * sum((prediction - observation) * (m * CASE WHEN observation < prediction THEN 1 ELSE 0 END - i + 0.5))
           / (max(m) * max(m)) AS crps,
       list(prediction) AS x
FROM (SELECT *, row_number() OVER (PARTITION BY {GROUP} ORDER BY prediction) AS i,
             count(*) OVER (PARTITION BY {GROUP}) AS m
      FROM (SELECT {KEYS}, parameter, prediction, observation FROM {{source}}) k) r
GROUP BY {GROUP}, observation"""

STATS = "mean, median, sd, quantile97_5, quantile02_5, quantile90, quantile10"


def sample_scores(source: str, columns: str) -> str:
    """Sample scores by the quantile form of the CRPS and a kernel density written out member by member."""
    parts = SAMPLE_PARTS.format(source=source)
    return f"""
SELECT {columns} FROM (
  SELECT *, near / 2 - ln(list_sum(list_transform(z2, lambda v: exp((near - v) / 2))) / (m * h * sqrt(2 * pi()))) AS logs
  FROM (SELECT *, list_min(z2) AS near FROM (
    SELECT *, list_transform(x, lambda v: pow((observation - v) / h, 2)) AS z2 FROM (
      SELECT *, nullif(1.06 * least(sd, iqr / 1.34) * pow(m, -0.2), 0) AS h FROM ({parts}) p) q) r) n) s"""


def wide(source: str, family: str, names: list[str]) -> str:
    """One row per forecast of a family with its parameters as columns."""
    picks = ", ".join(f"max(CASE WHEN parameter = '{n}' THEN prediction END) AS p_{n}" for n in names)
    return f"SELECT {GROUP}, observation AS y, {picks} FROM {source} WHERE family = '{family}' GROUP BY {GROUP}, observation"
