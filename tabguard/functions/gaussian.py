"""Normal tail functions for Arrow batches. Spark SQL has no error function, and no scipy is assumed."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np

_STANDARD = NormalDist()
Z95 = _STANDARD.inv_cdf(0.95)
"""95% quantile of the standard normal."""

_erfc = np.vectorize(math.erfc, otypes=[float])
_inv_cdf = np.vectorize(_STANDARD.inv_cdf, otypes=[float])
_ROOT2 = math.sqrt(2.0)
_FAR = 30.0
"""Beyond this many deviations the tail ratio uses its asymptotic series (erfc would underflow)."""


def upper_tail(a: np.ndarray) -> np.ndarray:
    """P(X > a)."""
    return 0.5 * _erfc(np.asarray(a, dtype=float) / _ROOT2)


def hazard(a: np.ndarray) -> np.ndarray:
    """Density over upper tail at a; for far tails a + 1/a - 2/a^3."""
    a = np.asarray(a, dtype=float)
    near = np.minimum(a, _FAR)
    value = np.exp(-0.5 * near * near) / math.sqrt(2 * math.pi) / upper_tail(near)
    far = np.maximum(a, _FAR)
    return np.where(a > _FAR, far + 1 / far - 2 / far**3, value)


def upper_quantile(tail: np.ndarray) -> np.ndarray:
    """x with P(X > x) = tail, for tail in (0, 1); accurate for small tails."""
    tail = np.clip(np.asarray(tail, dtype=float), 1e-300, 1 - 1e-16)
    return -_inv_cdf(tail)


def truncated_quantile(p: np.ndarray, mean: np.ndarray, sd: np.ndarray, low: float) -> np.ndarray:
    """p-quantile of a normal kept above ``low``."""
    a = (low - mean) / sd
    body = mean + sd * upper_quantile((1 - p) * upper_tail(np.minimum(a, _FAR)))
    # Far out the truncated normal is close to an exponential above the bound.
    far = low + sd * -np.log1p(-np.asarray(p, dtype=float)) / np.maximum(a, _FAR)
    return np.maximum(np.where(a > _FAR, far, body), low)


# Coefficients, highest power first, of Acklam's rational approximations of the normal quantile (central
# part and tails, relative error 1.2e-9) and of the Chebyshev fit of the complementary error function (1.2e-7).
_CENTRE = (
    [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00],
    [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0],
)
_OUTER = (
    [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00],
    [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0],
)
_TAIL = [
    0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223,
]
_OUTER_BELOW = 0.02425


def fast_upper_tail(a: np.ndarray) -> np.ndarray:
    """``upper_tail`` by polynomials, for whole arrays of draws."""
    x = np.abs(a) / _ROOT2
    t = 1.0 / (1.0 + 0.5 * x)
    tail = 0.5 * t * np.exp(np.polyval(_TAIL, t) - x * x)
    return np.where(a >= 0, tail, 1.0 - tail)


def fast_upper_quantile(tail: np.ndarray) -> np.ndarray:
    """``upper_quantile`` by rational functions, for whole arrays of draws."""
    tail = np.clip(tail, 1e-300, 1 - 1e-16)
    small = np.minimum(tail, 1 - tail)
    q = np.sqrt(-2 * np.log(small))
    outer = np.polyval(_OUTER[0], q) / np.polyval(_OUTER[1], q)  # below zero: the lower tail's quantile
    c = np.clip(0.5 - tail, _OUTER_BELOW - 0.5, 0.5 - _OUTER_BELOW)
    centre = c * np.polyval(_CENTRE[0], c * c) / np.polyval(_CENTRE[1], c * c)
    return np.where(small < _OUTER_BELOW, np.where(tail < 0.5, -outer, outer), centre)


def truncated_draws(
    rng: np.random.Generator, mean: np.ndarray, sd: np.ndarray, low: np.ndarray, high: np.ndarray
) -> np.ndarray:
    """One draw per element from a normal kept inside [low, high]."""
    mean, sd, low, high = np.broadcast_arrays(mean, sd, low, high)
    return truncated_points(rng.random(mean.shape), mean, sd, low, high)


def truncated_points(
    u: np.ndarray, mean: np.ndarray, sd: np.ndarray, low: np.ndarray, high: np.ndarray
) -> np.ndarray:
    """Points of a normal kept inside [low, high] at uniform numbers ``u``, by the inverse distribution function.

    Works on the upper tail after mirroring intervals that lie below the mean, which keeps both
    probabilities away from 1.
    """
    a, b = (low - mean) / sd, (high - mean) / sd
    mirror = b < -a
    a, b = np.where(mirror, -b, a), np.where(mirror, -a, b)
    tail_a, tail_b = fast_upper_tail(np.minimum(a, _FAR)), fast_upper_tail(np.minimum(b, _FAR + 8))
    body = fast_upper_quantile(tail_a - u * (tail_a - tail_b))
    steep = np.maximum(a, _FAR)
    far = a - np.log1p(u * np.expm1(-steep * np.minimum(b - a, 1e6))) / steep
    z = np.clip(np.where(a > _FAR, far, body), a, b)
    return np.clip(mean + sd * np.where(mirror, -z, z), low, high)


def sum_quantiles(mean: np.ndarray, sd: np.ndarray, probabilities: list[float], steps: int = 500) -> np.ndarray:
    """Quantiles of a sum of independent normals, each kept above zero; without deviation a part is constant.

    The distributions are convolved on a grid of ``steps`` cells for one deviation of the sum, 9 deviations to
    each side of a part, which is closer than millions of draws.
    """
    mean, sd = np.asarray(mean, float), np.asarray(sd, float)
    fixed = np.maximum(mean[sd <= 0], 0).sum()
    mean, sd = mean[sd > 0], sd[sd > 0]
    if not len(mean):
        return np.full(len(probabilities), fixed)
    h = float(np.sqrt((sd * sd).sum())) / steps
    start = np.floor(np.maximum(mean - 9 * sd, 0) / h)
    stop = np.ceil((np.maximum(mean, 0) + 9 * sd) / h)
    size = 1 << int((stop - start).sum() + len(mean)).bit_length()
    product = np.ones(size // 2 + 1, complex)
    for z, s, first, last in zip(mean, sd, start, stop):
        edges = (np.arange(first, last + 1) * h - z) / s
        a = -z / s
        if a > _FAR:
            above = np.exp(-a * (edges - a))
        else:
            above = np.minimum(fast_upper_tail(edges) / fast_upper_tail(np.float64(a)), 1.0)
        mass = -np.diff(above)
        product *= np.fft.rfft(mass / mass.sum(), size)
    reached = np.cumsum(np.fft.irfft(product, size))
    # a cell's mass lies around its middle, so a sum of k cells around k halves more
    at = np.interp(probabilities, reached, np.arange(size) + 0.5)
    return fixed + (start.sum() + at + len(mean) / 2) * h
