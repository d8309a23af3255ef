"""Distribution functions against sums and known expansions, up to large parameters."""

import math

import numpy as np
import pytest

from tallycast.functions import special


@pytest.mark.parametrize("shape", [50.0, 99.0, 101.0, 1e3, 1e5, 1e6, 1e7, 1e8])
def test_gamma_at_its_mean(shape):
    known = 0.5 + (1 / 3 + 1 / (540 * shape)) / math.sqrt(2 * math.pi * shape)
    assert special.gamma_cdf(np.array([shape]), np.array([shape]))[0] == pytest.approx(known, abs=0.02 * shape**-2.5 + 1e-12)


@pytest.mark.parametrize(("rate", "k"), [(3.0, 2), (90.0, 80), (150.0, 140), (150.0, 170), (1e4, 9900), (1e4, 10100)])
def test_poisson_is_the_sum_of_its_terms(rate, k):
    known = math.fsum(math.exp(i * math.log(rate) - rate - math.lgamma(i + 1)) for i in range(k + 1))
    assert special.poisson_cdf(np.array([rate]), np.array([float(k)]))[0] == pytest.approx(known, abs=2e-11)


@pytest.mark.parametrize(("a", "b", "x"), [(3, 4, 0.4), (120, 150, 0.45), (1000, 3000, 0.26), (150, 5, 0.97), (10_000, 30_000, 0.251)])
def test_beta_is_a_binomial_tail(a, b, x):
    n = a + b - 1
    terms = (math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(x) + (n - j) * math.log1p(-x) for j in range(a, n + 1))
    assert special.beta_cdf(np.array([float(a)]), np.array([float(b)]), np.array([x]))[0] == pytest.approx(math.fsum(map(math.exp, terms)), abs=2e-11)


@pytest.mark.parametrize("shape", [1e2, 1e4, 1e6, 1e8])
def test_symmetric_beta_has_half_below_the_middle(shape):
    assert special.beta_cdf(np.array([shape]), np.array([shape]), np.array([0.5]))[0] == pytest.approx(0.5, abs=1e-12)


@pytest.mark.parametrize("rate", [1e4, 1e6, 1e8])
def test_large_rates_score_like_their_normal(spark, rate):
    """At its mean a sharp forecast scores (sqrt 2 - 1) / sqrt pi of its spread."""
    rows = spark.createDataFrame([(rate, rate, 1.0, rate)], "lam double, shape double, rate double, y double")
    got = rows.select(
        special.poisson_crps(rows["lam"], rows["y"]).alias("p"), special.gamma_crps(rows["shape"], rows["rate"], rows["y"]).alias("g")
    ).first()
    known = (math.sqrt(2) - 1) / math.sqrt(math.pi) * math.sqrt(rate)
    assert got["p"] == pytest.approx(known, rel=20 / math.sqrt(rate) ** 1.0 * 0.05) and got["g"] == pytest.approx(known, rel=1 / math.sqrt(rate))


def test_what_does_not_converge_is_unknown(monkeypatch):
    monkeypatch.setattr(special, "_TERMS", 5)
    assert np.isnan(special.gamma_cdf(np.array([80.0]), np.array([80.0]))[0])
