import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.functions import scoring as rules
from tallycast.functions import special
from tallycast.functions.normal import normal_cdf

CASES = {
    "normal": ({"mu": 2.0, "sigma": 1.5}, 3.1),
    "lognormal": ({"mu": 0.3, "sigma": 0.6}, 1.7),
    "logistic": ({"location": 1.0, "scale": 0.7}, -0.4),
    "exponential": ({"rate": 0.8}, 2.2),
    "uniform": ({"min": -1.0, "max": 4.0}, 5.0),
    "gamma": ({"shape": 2.7, "rate": 1.3}, 1.1),
    "beta": ({"shape1": 2.3, "shape2": 0.9}, 0.35),
}


def cdf(family, p, x):
    if family == "normal":
        return np.array([0.5 * math.erfc(-(v - p["mu"]) / p["sigma"] / math.sqrt(2)) for v in x])
    if family == "lognormal":
        z = [(math.log(v) - p["mu"]) / p["sigma"] if v > 0 else -40 for v in x]
        return np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])
    if family == "logistic":
        return 1 / (1 + np.exp(-(x - p["location"]) / p["scale"]))
    if family == "exponential":
        return np.where(x > 0, 1 - np.exp(-p["rate"] * np.maximum(x, 0)), 0)
    if family == "uniform":
        return np.clip((x - p["min"]) / (p["max"] - p["min"]), 0, 1)
    if family == "gamma":
        return special.gamma_cdf(np.full_like(x, p["shape"]), p["rate"] * x)
    return special.beta_cdf(np.full_like(x, p["shape1"]), np.full_like(x, p["shape2"]), x)


def evaluate(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("family", CASES)
def test_crps_is_the_integral_of_the_squared_distance(spark, family):
    p, y = CASES[family]
    x = np.linspace(-40, 80, 1_200_001)
    want = float(np.sum((cdf(family, p, x) - (x >= y)) ** 2) * (x[1] - x[0]))
    got = evaluate(spark, rules.CRPS[family]({k: F.lit(v) for k, v in p.items()}, F.lit(y)))
    assert got == pytest.approx(want, abs=2e-4)


@pytest.mark.parametrize("family", CASES)
def test_log_score_is_minus_log_density(spark, family):
    p, y = CASES[family]
    if family == "uniform":
        y = 3.0
    h = 1e-5
    density = float(np.diff(cdf(family, p, np.array([y - h, y + h])))[0] / (2 * h))
    got = evaluate(spark, rules.LOGS[family]({k: F.lit(v) for k, v in p.items()}, F.lit(y)))
    assert got == pytest.approx(-math.log(density), abs=1e-5)


def test_poisson_against_sums(spark):
    lam, y = 3.4, 5.0
    pmf = np.array([math.exp(-lam + k * math.log(lam) - math.lgamma(k + 1)) for k in range(80)])
    want = float(np.sum((np.cumsum(pmf) - (np.arange(80) >= y)) ** 2))
    assert evaluate(spark, rules.crps_poisson({"lambda": F.lit(lam)}, F.lit(y))) == pytest.approx(want, abs=1e-9)
    assert evaluate(spark, rules.logs_poisson({"lambda": F.lit(lam)}, F.lit(y))) == pytest.approx(-math.log(pmf[5]))
    assert evaluate(spark, special.poisson_quantile(F.lit(lam), 0.975)) == np.searchsorted(np.cumsum(pmf), 0.975)


def test_quantiles_invert_the_distribution(spark):
    got = evaluate(spark, special.gamma_quantile(F.lit(2.7), F.lit(1.3), 0.95))
    assert special.gamma_cdf(np.array([2.7]), np.array([1.3 * got]))[0] == pytest.approx(0.95, abs=1e-9)
    got = evaluate(spark, special.beta_quantile(F.lit(2.3), F.lit(0.9), 0.05))
    assert special.beta_cdf(np.array([2.3]), np.array([0.9]), np.array([got]))[0] == pytest.approx(0.05, abs=1e-9)


def test_parameters_out_of_range_give_no_score(spark):
    assert evaluate(spark, rules.crps_gamma({"shape": F.lit(-1.0), "rate": F.lit(1.0)}, F.lit(1.0))) is None
    assert evaluate(spark, rules.crps_normal({"mu": F.lit(0.0), "sigma": F.lit(0.0)}, F.lit(1.0))) is None


def test_normal_cdf(spark):
    xs = [float(x) for x in np.linspace(-9, 9, 73)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", normal_cdf(F.col("x")).alias("p")).collect()
    assert max(abs(r["p"] - 0.5 * math.erfc(-r["x"] / math.sqrt(2))) for r in rows) < 1e-15


@pytest.mark.parametrize("members", [[4.0], [1.0, 1.0, 1.0], [3.0, -2.0, 7.5, 7.5, 0.1], list(np.linspace(-5, 5, 40))])
@pytest.mark.parametrize("y", [0.3, 99.0])
def test_sample_crps_equals_the_energy_form(spark, members, y):
    x = np.array(members, dtype=float)
    want = np.mean(np.abs(x - y)) - 0.5 * np.mean(np.abs(x[:, None] - x[None, :]))
    xs = F.array_sort(F.array(*[F.lit(float(v)) for v in members]))
    assert evaluate(spark, rules.sample_crps(xs, F.lit(y))) == pytest.approx(want, abs=1e-9)


def test_sample_log_score_survives_a_far_observation(spark):
    xs = F.array(*[F.lit(float(v)) for v in range(10)])
    got = evaluate(spark, rules.sample_logs(xs, F.lit(1e6), F.lit(0.5)))
    assert math.isfinite(got) and got > 1e11
