"""Proper scoring rules as column expressions.

Closed forms follow Gneiting & Raftery (2007) and Jordan, Krueger & Lerch (2019); the kernel density of a sample
follows Krueger, Lerch, Thorarinsdottir & Gneiting (2021). ``p`` maps a parameter name to its column, ``y`` is the
observation. A score that is not defined (spread of zero, value outside the support) is NULL or, for the log score
of an impossible value, positive infinity.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallycast.functions import special
from tallycast.functions.normal import normal_cdf, normal_pdf

Params = dict[str, Column]

# Normal quantiles for 0.975 and 0.95.
Z975 = 1.959963984540054
Z95 = 1.6448536269514722
#: (column, probability): the 95 % limits and the 90 % limits of a forecast.
LIMITS = {"quantile97_5": 0.975, "quantile02_5": 0.025, "quantile90": 0.95, "quantile10": 0.05}
_Z = {"quantile97_5": Z975, "quantile02_5": -Z975, "quantile90": Z95, "quantile10": -Z95}


def _inf() -> Column:
    return F.lit(float("inf"))


def _zero() -> Column:
    return F.lit(0.0)


# --- continuous ranked probability score -----------------------------------------------------------------


def crps_normal(p: Params, y: Column) -> Column:
    z = F.try_divide(y - p["mu"], p["sigma"])
    return p["sigma"] * (z * (2 * normal_cdf(z) - 1) + 2 * normal_pdf(z) - F.lit(1 / math.sqrt(math.pi)))


def crps_lognormal(p: Params, y: Column) -> Column:
    mu, sigma = p["mu"], p["sigma"]
    w = F.try_divide(F.ln(F.when(y > 0, y)) - mu, sigma)
    below = F.when(y > 0, normal_cdf(w)).otherwise(_zero())
    below_shifted = F.when(y > 0, normal_cdf(w - sigma)).otherwise(_zero())
    mean = F.exp(mu + sigma * sigma / 2)
    return y * (2 * below - 1) - 2 * mean * (below_shifted + normal_cdf(sigma / F.lit(math.sqrt(2))) - 1)


def crps_logistic(p: Params, y: Column) -> Column:
    z = F.try_divide(y - p["location"], p["scale"])
    # ln F(z) = -ln(1 + exp(-z)), written so that exp never overflows
    ln_cdf = F.when(z >= 0, -F.log1p(F.exp(-F.abs(z)))).otherwise(z - F.log1p(F.exp(-F.abs(z))))
    return p["scale"] * (z - 2 * ln_cdf - 1)


def crps_exponential(p: Params, y: Column) -> Column:
    rate = p["rate"]
    below = F.when(y > 0, 1 - F.exp(-rate * y)).otherwise(_zero())
    inside = y - F.try_divide(2 * below, rate) + F.try_divide(F.lit(0.5), rate)
    return F.when(y >= 0, inside).otherwise(-y + F.try_divide(F.lit(0.5), rate))


def crps_uniform(p: Params, y: Column) -> Column:
    width = p["max"] - p["min"]
    z = F.try_divide(y - p["min"], width)
    below = F.least(F.greatest(z, _zero()), F.lit(1.0))
    return width * (F.abs(z - below) + below * below - below + F.lit(1.0 / 3))


def crps_bernoulli(p: Params, y: Column) -> Column:
    return (p["prob"] - y) * (p["prob"] - y)


def crps_poisson(p: Params, y: Column) -> Column:
    return special.poisson_crps(p["lambda"], y)


def crps_gamma(p: Params, y: Column) -> Column:
    return special.gamma_crps(p["shape"], p["rate"], y)


def crps_beta(p: Params, y: Column) -> Column:
    return special.beta_crps(p["shape1"], p["shape2"], y)


# --- logarithmic score -----------------------------------------------------------------------------------


def logs_normal(p: Params, y: Column) -> Column:
    z = F.try_divide(y - p["mu"], p["sigma"])
    return z * z / 2 + F.ln(p["sigma"]) + F.lit(0.5 * math.log(2 * math.pi))


def logs_lognormal(p: Params, y: Column) -> Column:
    log_y = F.ln(F.when(y > 0, y))
    return F.when(y > 0, logs_normal(p, log_y) + log_y).otherwise(_inf())


def logs_logistic(p: Params, y: Column) -> Column:
    z = F.abs(F.try_divide(y - p["location"], p["scale"]))
    return z + 2 * F.log1p(F.exp(-z)) + F.ln(p["scale"])


def logs_exponential(p: Params, y: Column) -> Column:
    return F.when(y >= 0, p["rate"] * y - F.ln(p["rate"])).otherwise(_inf())


def logs_uniform(p: Params, y: Column) -> Column:
    return F.when(y.between(p["min"], p["max"]), F.ln(p["max"] - p["min"])).otherwise(_inf())


def logs_bernoulli(p: Params, y: Column) -> Column:
    chance = F.when(y == 1, p["prob"]).when(y == 0, 1 - p["prob"]).otherwise(_zero())
    return F.when(chance > 0, -F.ln(F.when(chance > 0, chance))).otherwise(_inf())


def logs_poisson(p: Params, y: Column) -> Column:
    return special.poisson_logs(p["lambda"], y)


def logs_gamma(p: Params, y: Column) -> Column:
    return special.gamma_logs(p["shape"], p["rate"], y)


def logs_beta(p: Params, y: Column) -> Column:
    return special.beta_logs(p["shape1"], p["shape2"], y)


CRPS: dict[str, Callable[[Params, Column], Column]] = {
    "normal": crps_normal,
    "lognormal": crps_lognormal,
    "logistic": crps_logistic,
    "exponential": crps_exponential,
    "uniform": crps_uniform,
    "bernoulli": crps_bernoulli,
    "poisson": crps_poisson,
    "gamma": crps_gamma,
    "beta": crps_beta,
}

LOGS: dict[str, Callable[[Params, Column], Column]] = {
    "normal": logs_normal,
    "lognormal": logs_lognormal,
    "logistic": logs_logistic,
    "exponential": logs_exponential,
    "uniform": logs_uniform,
    "bernoulli": logs_bernoulli,
    "poisson": logs_poisson,
    "gamma": logs_gamma,
    "beta": logs_beta,
}


# --- mean, spread and limits of a parametric forecast -------------------------------------------------------


def _location_spread(mean: Column, median: Column, sd: Column, limits: Callable[[str, float], Column]) -> Params:
    return {"mean": mean, "median": median, "sd": sd, **{name: limits(name, q) for name, q in LIMITS.items()}}


def _stats_normal(p: Params) -> Params:
    return _location_spread(p["mu"], p["mu"], p["sigma"], lambda n, q: p["mu"] + p["sigma"] * F.lit(_Z[n]))


def _stats_lognormal(p: Params) -> Params:
    mu, var = p["mu"], p["sigma"] * p["sigma"]
    return _location_spread(
        F.exp(mu + var / 2),
        F.exp(mu),
        F.sqrt(F.expm1(var)) * F.exp(mu + var / 2),
        lambda n, q: F.exp(mu + p["sigma"] * F.lit(_Z[n])),
    )


def _stats_logistic(p: Params) -> Params:
    at, scale = p["location"], p["scale"]
    sd = scale * F.lit(math.pi / math.sqrt(3))
    return _location_spread(at, at, sd, lambda n, q: at + scale * F.lit(math.log(q / (1 - q))))


def _stats_exponential(p: Params) -> Params:
    scale = F.try_divide(F.lit(1.0), p["rate"])
    return _location_spread(scale, scale * F.lit(math.log(2)), scale, lambda n, q: scale * F.lit(-math.log1p(-q)))


def _stats_uniform(p: Params) -> Params:
    low, width = p["min"], p["max"] - p["min"]
    middle = low + width * F.lit(0.5)
    return _location_spread(middle, middle, width / F.lit(math.sqrt(12)), lambda n, q: low + width * F.lit(q))


def _stats_bernoulli(p: Params) -> Params:
    prob = p["prob"]

    def quantile(q: float) -> Column:
        return F.when(F.lit(q) <= 1 - prob, _zero()).otherwise(F.lit(1.0))

    return _location_spread(prob, quantile(0.5), F.sqrt(prob * (1 - prob)), lambda n, q: quantile(q))


def _stats_poisson(p: Params) -> Params:
    rate = p["lambda"]
    return _location_spread(
        rate, special.poisson_quantile(rate, 0.5), F.sqrt(rate), lambda n, q: special.poisson_quantile(rate, q)
    )


def _stats_gamma(p: Params) -> Params:
    a, b = p["shape"], p["rate"]
    return _location_spread(
        a / b, special.gamma_quantile(a, b, 0.5), F.sqrt(a) / b, lambda n, q: special.gamma_quantile(a, b, q)
    )


def _stats_beta(p: Params) -> Params:
    a, b = p["shape1"], p["shape2"]
    total = a + b
    return _location_spread(
        a / total,
        special.beta_quantile(a, b, 0.5),
        F.sqrt(a * b / (total + 1)) / total,
        lambda n, q: special.beta_quantile(a, b, q),
    )


PARAMETRIC_STATS: dict[str, Callable[[Params], Params]] = {
    "normal": _stats_normal,
    "lognormal": _stats_lognormal,
    "logistic": _stats_logistic,
    "exponential": _stats_exponential,
    "uniform": _stats_uniform,
    "bernoulli": _stats_bernoulli,
    "poisson": _stats_poisson,
    "gamma": _stats_gamma,
    "beta": _stats_beta,
}


# --- samples ------------------------------------------------------------------------------------------------


def _at(xs: Column, position: Column) -> Column:
    """Linear interpolation between order statistics; ``position`` counts from 0."""
    low = F.floor(position).cast("int")
    high = F.ceil(position).cast("int")
    below = F.get(xs, low)
    return below + (F.get(xs, high) - below) * (position - low)


def sample_quantile(xs: Column, q: float) -> Column:
    """Quantile of a sorted array (the usual interpolation between order statistics)."""
    return _at(xs, (F.size(xs) - 1) * F.lit(q))


def sample_crps(xs: Column, y: Column) -> Column:
    """CRPS of the empirical distribution of a sorted array.

    mean |x - y| - sum_i (2 i - m - 1) x_i / m^2, with i counted from 1.
    """
    start = F.struct(F.lit(0).alias("i"), _zero().alias("miss"), _zero().alias("spread"))
    size = F.size(xs)
    return F.aggregate(
        xs,
        start,
        lambda a, x: F.struct(
            (a["i"] + 1).alias("i"),
            (a["miss"] + F.abs(x - y)).alias("miss"),
            (a["spread"] + (2 * (a["i"] + 1) - size - 1) * x).alias("spread"),
        ),
        lambda a: a["miss"] / size - a["spread"] / (size.cast("double") * size),
    )


def kernel_bandwidth(size: Column, sd: Column, iqr: Column) -> Column:
    """Normal reference bandwidth; NULL when the sample has no spread."""
    width = F.lit(1.06) * F.least(sd, iqr / F.lit(1.34)) * F.pow(size.cast("double"), F.lit(-0.2))
    return F.when(width > 0, width)


def sample_logs(xs: Column, y: Column, bandwidth: Column) -> Column:
    """Log score of a Gaussian kernel density.

    One pass that keeps the sum relative to the nearest member, so that a far observation does not underflow to
    log 0. The bandwidth travels in the accumulator: named inside the fold it would be worked out per member.
    """
    start = F.struct(bandwidth.alias("h"), _inf().alias("near"), _zero().alias("total"))

    def step(a: Column, x: Column) -> Column:
        z = (y - x) / a["h"]
        gap = (a["near"] - z * z) / 2
        return F.struct(
            a["h"].alias("h"),
            F.least(a["near"], z * z).alias("near"),
            F.when(gap > 0, a["total"] * F.exp(-gap) + 1).otherwise(a["total"] + F.exp(gap)).alias("total"),
        )

    def finish(a: Column) -> Column:
        return a["near"] / 2 - F.ln(a["total"] / F.size(xs)) + F.ln(a["h"]) + F.lit(0.5 * math.log(2 * math.pi))

    return F.when(bandwidth.isNotNull(), F.aggregate(xs, start, step, finish))
