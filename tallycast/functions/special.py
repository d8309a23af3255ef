"""Distributions that column arithmetic cannot express.

Gamma and beta need the incomplete gamma and beta functions. They run as Arrow batches with numpy: every helper
works on whole arrays, so a batch costs a fixed number of vector operations.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# the functions below travel with the task, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Terms of a series or fraction at most; what has not converged by then is unknown (NaN).
_TERMS = 20_000
_EPS = 1e-15
_TINY = 1e-300
#: From this shape on distribution functions are integrated: the density is then smooth and narrow.
_LARGE = 100.0
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(96)

# Lanczos approximation of the gamma function, g = 7, nine terms.
_LANCZOS = [
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
]


def ln_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x) for x > 0."""
    x = np.asarray(x, dtype=float)
    small = x < 0.5
    z = np.where(small, 1.0 - x, x) - 1.0
    series = np.full_like(z, _LANCZOS[0])
    for k, c in enumerate(_LANCZOS[1:], start=1):
        series = series + c / (z + k)
    t = z + 7.5
    value = 0.5 * math.log(2 * math.pi) + (z + 0.5) * np.log(t) - t + np.log(series)
    reflected = np.log(np.pi / np.abs(np.sin(np.pi * np.where(small, x, 0.25)))) - value
    return np.where(small, reflected, value)


def _stirling(x: np.ndarray) -> np.ndarray:
    """What ln Gamma(x + 1) has beyond x ln x - x + ln(2 pi x) / 2, for x of about 30 and more."""
    z = 1.0 / (x * x)
    return (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / x


def _log_ratio(u: np.ndarray) -> np.ndarray:
    """ln(1 + u) - u without cancellation."""
    near = np.abs(u) < 0.01
    v = np.where(near, u, 0.0)
    powers = sum((-1) ** (k + 1) * v**k / k for k in range(2, 12))
    with np.errstate(divide="ignore"):
        return np.where(near, powers, np.log1p(np.where(near, 0.0, np.maximum(u, -1.0))) - u)


def _integrated(density, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The integral of a smooth density from low to high, by Gauss and Legendre."""
    half = 0.5 * (high - low)
    total = np.zeros_like(half)
    for node, weight in zip(_NODES, _WEIGHTS):
        total += weight * density(low + half * (node + 1.0))
    return half * total


def _from_nearer_tail(density, x: np.ndarray, mode: np.ndarray, width: np.ndarray, least, most) -> np.ndarray:
    """The distribution function at x, integrated from the tail on the same side of the mode."""
    left = x < mode
    low = np.where(left, np.maximum(least, np.minimum(x, mode - 14 * width) - 2 * width), x)
    high = np.where(left, x, np.minimum(most, np.maximum(x, mode + 14 * width) + 2 * width))
    part = _integrated(density, low, high)
    return np.clip(np.where(left, part, 1.0 - part), 0.0, 1.0)


def gamma_weight(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """x^a e^-x / Gamma(a + 1) for x > 0."""
    large = a >= _LARGE
    big = np.where(large, a, _LARGE)
    with np.errstate(divide="ignore"):
        far = big * _log_ratio((x - big) / big) - _stirling(big) - 0.5 * np.log(2 * np.pi * big)
        small = np.where(large, 1.0, a)
        near = small * np.log(x) - x - ln_gamma(small + 1.0)
    return np.exp(np.where(large, far, near))


def gamma_cdf(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma function P(a, x)."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    out = np.zeros(x.shape)
    small, large = (x > 0) & (a < _LARGE), (x > 0) & (a >= _LARGE)
    with np.errstate(over="ignore", invalid="ignore"):
        if small.any():
            out[small] = _gamma_cdf_positive(a[small], x[small])
        if large.any():
            shape, at = a[large], x[large]
            mode = shape - 1.0
            out[large] = _from_nearer_tail(lambda t: gamma_weight(mode, t), at, mode, np.sqrt(mode), 0.0, np.inf)
    return out


def _gamma_cdf_positive(a: np.ndarray, xs: np.ndarray) -> np.ndarray:
    front = np.exp(a * np.log(xs) - xs - ln_gamma(a))
    # series, good left of the mode
    term = 1.0 / a
    total = term.copy()
    for n in range(1, _TERMS):
        term = term * xs / (a + n)
        total = total + term
        if np.all((term <= total * _EPS) | (xs >= a + 1.0)):
            break
    left = np.where(term <= total * _EPS, front * total, np.nan)
    # continued fraction (modified Lentz), good right of it
    b = xs + 1.0 - a
    c = np.full_like(xs, 1.0 / _TINY)
    d = 1.0 / np.where(np.abs(b) < _TINY, _TINY, b)
    h = d.copy()
    for n in range(1, _TERMS):
        an = -n * (n - a)
        b = b + 2.0
        d = an * d + b
        d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
        c = b + an / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        step = d * c
        h = h * step
        done = np.abs(step - 1.0) < _EPS * 10
        if np.all(done | (xs < a + 1.0)):
            break
    right = np.where(done, 1.0 - front * h, np.nan)
    return np.where(xs < a + 1.0, left, right)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
    h = d.copy()
    for m in range(1, _TERMS):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = 1.0 + step / c
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            h = h * d * c
        done = np.abs(d * c - 1.0) < _EPS * 10
        if np.all(done):
            break
    return np.where(done, h, np.nan)


def beta_weight(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """x^a (1 - x)^b (a + b)! / (a! b!) for 0 < x < 1."""
    large = (a >= _LARGE) & (b >= _LARGE)
    p, q = np.where(large, a, _LARGE), np.where(large, b, _LARGE)
    n = p + q
    # around the mode p / n the powers of ten cancel
    u = (x * n - p) / p
    v = (p - x * n) / q
    far = p * _log_ratio(u) + q * _log_ratio(v) + 0.5 * np.log(n / (2 * np.pi * p * q)) + _stirling(n) - _stirling(p) - _stirling(q)
    p, q = np.where(large, 1.0, a), np.where(large, 1.0, b)
    near = ln_gamma(p + q + 1.0) - ln_gamma(p + 1.0) - ln_gamma(q + 1.0) + p * np.log(x) + q * np.log1p(-x)
    return np.exp(np.where(large, far, near))


def beta_cdf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b)."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    out = np.where(x >= 1, 1.0, 0.0)
    inside = (x > 0) & (x < 1)
    large = inside & (a > _LARGE + 1) & (b > _LARGE + 1)
    small = inside & ~large
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        if small.any():
            out[small] = _beta_cdf_inside(a[small], b[small], x[small])
        if large.any():
            p, q = a[large] - 1.0, b[large] - 1.0
            n = p + q
            density = lambda t: (n + 1.0) * beta_weight(p, q, t)
            out[large] = _from_nearer_tail(density, x[large], p / n, np.sqrt(p * q / n) / n, 1e-300, 1.0 - 1e-16)
    return out


def _beta_cdf_inside(a: np.ndarray, b: np.ndarray, xs: np.ndarray) -> np.ndarray:
    front = np.exp(ln_gamma(a + b) - ln_gamma(a) - ln_gamma(b) + a * np.log(xs) + b * np.log1p(-xs))
    flip = xs >= (a + 1.0) / (a + b + 2.0)
    fa, fb, fx = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1.0 - xs, xs)
    value = front * _beta_fraction(fa, fb, fx) / fa
    return np.where(flip, 1.0 - value, value)


def _ln_beta(a, b):
    return ln_gamma(a) + ln_gamma(b) - ln_gamma(np.asarray(a, float) + b)


def _half_step(a: np.ndarray) -> np.ndarray:
    """Gamma(a + 1/2) / Gamma(a)."""
    z = 1.0 / a
    far = np.sqrt(a) * (1 - z / 8 * (1 - z / 16 * (1 + z * 5 / 8 * (1 - z * 21 / 80))))
    small = np.minimum(a, 1e3)
    return np.where(a >= 1e3, far, np.exp(ln_gamma(small + 0.5) - ln_gamma(small)))


def _spread_ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """B(2a, 2b) / (a B(a, b)^2)."""
    large = (a >= _LARGE) & (b >= _LARGE)
    p, q = np.where(large, a, _LARGE), np.where(large, b, _LARGE)
    n = p + q
    beyond = lambda k: _stirling(k * p) + _stirling(k * q) - _stirling(k * n)
    far = 0.5 * np.log(p * q / (4 * np.pi * n)) + beyond(2.0) - 2 * beyond(1.0) - np.log(p)
    p, q = np.where(large, 1.0, a), np.where(large, 1.0, b)
    return np.exp(np.where(large, far, _ln_beta(2 * p, 2 * q) - 2 * _ln_beta(p, q) - np.log(p)))


def _bisect(cdf, low: np.ndarray, high: np.ndarray, q: float) -> np.ndarray:
    """Invert a continuous distribution function on known bounds."""
    for _ in range(90):
        middle = 0.5 * (low + high)
        below = cdf(middle) < q
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return 0.5 * (low + high)


def _guarded(values: np.ndarray, ok: np.ndarray) -> pd.Series:
    return pd.Series(np.where(ok & ~np.isnan(values), values, np.nan)).astype(object).where(lambda s: s.notna(), None)


def _arrays(*series: pd.Series) -> list[np.ndarray]:
    return [s.to_numpy(dtype=float, na_value=np.nan) for s in series]


def gamma_crps(shape: Column, rate: Column, y: Column) -> Column:
    @F.pandas_udf("double")
    def score(shape: pd.Series, rate: pd.Series, y: pd.Series) -> pd.Series:
        a, b, x = _arrays(shape, rate, y)
        ok = (a > 0) & (b > 0) & ~np.isnan(x)
        a, b, x = np.where(ok, a, 1.0), np.where(ok, b, 1.0), np.where(ok, x, 0.0)
        z = b * x
        weight = np.where(z > 0, gamma_weight(a, np.maximum(z, _TINY)), 0.0)
        value = ((z - a) * (2 * gamma_cdf(a, z) - 1) + 2 * a * weight - _half_step(a) / math.sqrt(math.pi)) / b
        return _guarded(value, ok)

    return score(shape, rate, y)


def gamma_logs(shape: Column, rate: Column, y: Column) -> Column:
    @F.pandas_udf("double")
    def score(shape: pd.Series, rate: pd.Series, y: pd.Series) -> pd.Series:
        a, b, x = _arrays(shape, rate, y)
        ok = (a > 0) & (b > 0) & ~np.isnan(x)
        inside = ok & (x > 0)
        a, b, xs = np.where(ok, a, 1.0), np.where(ok, b, 1.0), np.where(inside, x, 1.0)
        value = -(a * np.log(b) - ln_gamma(a) + (a - 1) * np.log(xs) - b * xs)
        return _guarded(np.where(inside, value, np.inf), ok)

    return score(shape, rate, y)


def gamma_quantile(shape: Column, rate: Column, q: float) -> Column:
    @F.pandas_udf("double")
    def value(shape: pd.Series, rate: pd.Series) -> pd.Series:
        a, b = _arrays(shape, rate)
        ok = (a > 0) & (b > 0)
        a, b = np.where(ok, a, 1.0), np.where(ok, b, 1.0)
        top = a + 40.0 * np.sqrt(a) + 40.0
        return _guarded(_bisect(lambda x: gamma_cdf(a, x), np.zeros_like(a), top, q) / b, ok)

    return value(shape, rate)


def beta_crps(shape1: Column, shape2: Column, y: Column) -> Column:
    @F.pandas_udf("double")
    def score(shape1: pd.Series, shape2: pd.Series, y: pd.Series) -> pd.Series:
        a, b, x = _arrays(shape1, shape2, y)
        ok = (a > 0) & (b > 0) & ~np.isnan(x)
        a, b, x = np.where(ok, a, 1.0), np.where(ok, b, 1.0), np.where(ok, x, 0.5)
        inside = (x > 0) & (x < 1)
        weight = np.where(inside, beta_weight(a, b, np.where(inside, x, 0.5)) * b / (a + b), 0.0)
        mean = a / (a + b)
        value = (x - mean) * (2 * beta_cdf(a, b, x) - 1) + 2 * mean * (weight - _spread_ratio(a, b))
        return _guarded(value, ok)

    return score(shape1, shape2, y)


def beta_logs(shape1: Column, shape2: Column, y: Column) -> Column:
    @F.pandas_udf("double")
    def score(shape1: pd.Series, shape2: pd.Series, y: pd.Series) -> pd.Series:
        a, b, x = _arrays(shape1, shape2, y)
        ok = (a > 0) & (b > 0) & ~np.isnan(x)
        inside = ok & (x > 0) & (x < 1)
        a, b, xs = np.where(ok, a, 1.0), np.where(ok, b, 1.0), np.where(inside, x, 0.5)
        value = _ln_beta(a, b) - (a - 1) * np.log(xs) - (b - 1) * np.log1p(-xs)
        return _guarded(np.where(inside, value, np.inf), ok)

    return score(shape1, shape2, y)


def beta_quantile(shape1: Column, shape2: Column, q: float | Column) -> Column:
    @F.pandas_udf("double")
    def value(shape1: pd.Series, shape2: pd.Series, q: pd.Series) -> pd.Series:
        a, b, at = _arrays(shape1, shape2, q)
        ok = (a > 0) & (b > 0) & (at >= 0) & (at <= 1)
        a, b, at = np.where(ok, a, 1.0), np.where(ok, b, 1.0), np.where(ok, at, 0.5)
        return _guarded(_bisect(lambda x: beta_cdf(a, b, x), np.zeros_like(a), np.ones_like(a), at), ok)

    return value(shape1, shape2, q if isinstance(q, Column) else F.lit(float(q)))


# --- Poisson ------------------------------------------------------------------------------------------------


def poisson_cdf(rate: np.ndarray, k: np.ndarray) -> np.ndarray:
    """P(X <= k) through the incomplete gamma function."""
    count = np.floor(k)
    ok = count >= 0
    return np.where(ok, 1.0 - gamma_cdf(np.where(ok, count, 0.0) + 1.0, rate), 0.0)


def poisson_pmf(rate: np.ndarray, k: np.ndarray) -> np.ndarray:
    whole = (k >= 0) & (np.floor(k) == k)
    return np.where(whole, gamma_weight(np.where(whole, k, 0.0), rate), 0.0)


def _scaled_bessel_pair(x: np.ndarray) -> np.ndarray:
    """exp(-x) (I0(x) + I1(x)).

    As the mean of (1 + cos t) exp(x (cos t - 1)) over half a turn, by the trapezoid rule, which converges
    geometrically on a periodic function; for large x by the expansion in powers of 1 / x.
    """
    large = x > 200
    near = np.where(large, 0.0, x)
    nodes = 64 + 16 * 15
    t = np.linspace(0.0, math.pi, nodes + 1)
    weights = np.full(nodes + 1, 1.0 / nodes)
    weights[[0, -1]] *= 0.5
    total = np.zeros_like(near)
    for angle, weight in zip(t, weights):
        total += weight * (1 + math.cos(angle)) * np.exp(near * (math.cos(angle) - 1))
    far = np.where(large, x, 200.0)
    pair = np.zeros_like(far)
    for order in (0, 1):
        term, series = np.ones_like(far), np.ones_like(far)
        for k in range(1, 12):
            term = -term * (4 * order * order - (2 * k - 1) ** 2) / (8 * k * far)
            series = series + term
        pair += series / np.sqrt(2 * math.pi * far)
    return np.where(large, pair, total)


def poisson_crps(rate: Column, y: Column) -> Column:
    @F.pandas_udf("double")
    def score(rate: pd.Series, y: pd.Series) -> pd.Series:
        lam, x = _arrays(rate, y)
        ok = (lam > 0) & ~np.isnan(x)
        lam, x = np.where(ok, lam, 1.0), np.where(ok, x, 0.0)
        value = (
            (x - lam) * (2 * poisson_cdf(lam, x) - 1)
            + 2 * lam * poisson_pmf(lam, np.floor(x))
            - lam * _scaled_bessel_pair(2 * lam)
        )
        return _guarded(value, ok)

    return score(rate, y)


def poisson_logs(rate: Column, y: Column) -> Column:
    @F.pandas_udf("double")
    def score(rate: pd.Series, y: pd.Series) -> pd.Series:
        lam, x = _arrays(rate, y)
        ok = (lam > 0) & ~np.isnan(x)
        whole = ok & (x >= 0) & (np.floor(x) == x)
        lam, xs = np.where(ok, lam, 1.0), np.where(whole, x, 0.0)
        value = lam + ln_gamma(xs + 1.0) - xs * np.log(lam)
        return _guarded(np.where(whole, value, np.inf), ok)

    return score(rate, y)


def poisson_quantile(rate: Column, q: float) -> Column:
    """Smallest count whose distribution function reaches q."""

    @F.pandas_udf("double")
    def value(rate: pd.Series) -> pd.Series:
        (lam,) = _arrays(rate)
        ok = lam > 0
        lam = np.where(ok, lam, 1.0)
        low = np.full_like(lam, -1.0)
        high = np.ceil(lam + 40.0 * np.sqrt(lam) + 40.0)
        while np.any(high - low > 1):
            middle = np.floor((low + high) / 2)
            reached = poisson_cdf(lam, middle) >= q
            low, high = np.where(reached, low, middle), np.where(reached, middle, high)
        return _guarded(high, ok)

    return value(rate)
