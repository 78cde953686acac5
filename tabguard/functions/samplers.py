"""Exact integer noise on Arrow batches of aggregate rows, the same whenever it is evaluated.

The draws use integer arithmetic and uniform integers only, so the released values leak nothing
through floating point. Method: Canonne, Kamath and Steinke, "The Discrete Gaussian for Differential
Privacy" (2020): Bernoulli(exp(-x)) by a race of uniforms, a discrete Laplace from it, and a discrete
Gaussian by rejection from the Laplace. Real-valued measures use the same draws on a fixed grid.

Uniform bits come from a keyed hash (BLAKE2b) in counter mode: a secret key per release, and for every row the values of
its key columns. Without the key the bits cannot be told from random ones; with it a lost task, a retry or a second
evaluation of the plan draws the same noise again, so no answer is ever released with two draws. The key is drawn from
the operating system and lives in the plan; whoever holds it can take the noise away.

Aggregate output rows (one per key) reach these functions, and the distinct values that a quantile chooses from.
"""

from __future__ import annotations

import hashlib
import math
import os
from collections.abc import Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRID_BITS = 20
"""Noise for real-valued measures is a multiple of 2**-GRID_BITS."""


def secret_key(seed: int | None = None) -> bytes:
    """Key of one release, from operating-system entropy; a seeded one exists for tests only."""
    return os.urandom(32) if seed is None else hashlib.blake2b(str(seed).encode(), digest_size=32).digest()


class KeyedDraws:
    """Uniform integers that follow from a key and a row alone."""

    def __init__(self, key: bytes, row: str):
        self._hash = hashlib.blake2b(row.encode(), key=key, person=b"noise")
        self._block = self._held = self._bits = 0

    def bits(self, n: int) -> int:
        """An integer of ``n`` uniform bits."""
        while self._bits < n:
            block = self._hash.copy()
            block.update(self._block.to_bytes(8, "little"))
            self._held |= int.from_bytes(block.digest(), "little") << self._bits
            self._block += 1
            self._bits += 512
        out = self._held & ((1 << n) - 1)
        self._held >>= n
        self._bits -= n
        return out

    def randrange(self, n: int) -> int:
        """A uniform integer below ``n``."""
        while True:
            out = self.bits((n - 1).bit_length())
            if out < n:
                return out


def _bernoulli_exp_unit(x: Fraction, rng: KeyedDraws) -> bool:
    """True with probability exp(-x) for 0 <= x <= 1."""
    k = 1
    while rng.randrange(x.denominator * k) < x.numerator:
        k += 1
    return k % 2 == 1


def _bernoulli_exp(x: Fraction, rng: KeyedDraws) -> bool:
    """True with probability exp(-x) for any x >= 0."""
    whole = x.numerator // x.denominator
    for _ in range(whole):
        if not _bernoulli_exp_unit(Fraction(1), rng):
            return False
    return _bernoulli_exp_unit(x - whole, rng)


def discrete_laplace(scale: Fraction, rng: KeyedDraws) -> int:
    """Integer k with probability proportional to exp(-|k| / scale)."""
    top, step = scale.numerator, scale.denominator
    while True:
        low = rng.randrange(top)
        if not _bernoulli_exp_unit(Fraction(low, top), rng):
            continue
        high = 0
        while _bernoulli_exp_unit(Fraction(1), rng):
            high += 1
        size = (low + top * high) // step
        negative = rng.randrange(2) == 1
        if negative and size == 0:
            continue
        return -size if negative else size


def discrete_gaussian(variance: Fraction, rng: KeyedDraws) -> int:
    """Integer k with probability proportional to exp(-k^2 / (2 * variance))."""
    t = math.isqrt(variance.numerator // variance.denominator) + 1
    while True:
        k = discrete_laplace(Fraction(t), rng)
        excess = (abs(k) - variance / t) ** 2 / (2 * variance)
        if _bernoulli_exp(excess, rng):
            return k


def _draw(kind: str, parameter: Fraction, rng: KeyedDraws) -> int:
    if parameter == 0:
        return 0
    return discrete_laplace(parameter, rng) if kind == "laplace" else discrete_gaussian(parameter, rng)


def _integer_noise(kind: str, key: bytes):
    @F.pandas_udf(T.LongType())
    def add(value: pd.Series, num: pd.Series, den: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series(
            [
                int(v) + _draw(kind, Fraction(int(n), int(d)), KeyedDraws(key, r))
                for v, n, d, r in zip(value, num, den, row)
            ],
            dtype="int64",
        )

    return add


def _grid_noise(kind: str, key: bytes):
    power = 1 if kind == "laplace" else 2

    @F.pandas_udf(T.DoubleType())
    def add(value: pd.Series, num: pd.Series, den: pd.Series, row: pd.Series) -> pd.Series:
        grid = 2.0**GRID_BITS
        out = []
        for v, n, d, r in zip(value, num, den, row):
            parameter = Fraction(int(n), int(d))
            if parameter == 0:
                out.append(float(v))
            else:
                on_grid = parameter * 2 ** (GRID_BITS * power)
                out.append((round(v * grid) + _draw(kind, on_grid, KeyedDraws(key, r))) / grid)
        return pd.Series(out, dtype="float64")

    return add


def row_text(label: str, row: Sequence[Column | str]) -> Column:
    """Text that tells a row from all others of a release: what is drawn, and the values of the key columns.

    Names do not count, order and nulls do; texts are quoted, so that no two lists of values give the same.
    """
    cells = [(F.col(c) if isinstance(c, str) else c).alias(f"c{i}") for i, c in enumerate(row)]
    if not cells:
        return F.lit(label)
    return F.concat(F.lit(label + ":"), F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}))


def add_noise(
    value: Column,
    mechanism: str,
    num: Column,
    den: Column,
    row: Sequence[Column | str],
    label: str = "",
    key: bytes | None = None,
) -> Column:
    """``value`` plus one draw per row.

    ``num / den`` is the scale for ``geometric`` and ``laplace`` and the variance for
    ``discrete_gaussian`` and ``gaussian``; both are integer columns given as text or long. The columns ``row`` tell the
    rows apart (rows with equal ones get equal noise), ``label`` the answers drawn under one ``key``.
    """
    key = secret_key() if key is None else key
    cells = (num.cast("string"), den.cast("string"), row_text(f"{mechanism} {label}", row))
    if mechanism == "geometric":
        return _integer_noise("laplace", key)(value.cast("long"), *cells)
    if mechanism == "discrete_gaussian":
        return _integer_noise("gaussian", key)(value.cast("long"), *cells)
    if mechanism == "laplace":
        return _grid_noise("laplace", key)(value.cast("double"), *cells)
    if mechanism == "gaussian":
        return _grid_noise("gaussian", key)(value.cast("double"), *cells)
    raise ValueError(f"unknown noise mechanism {mechanism!r}")


def uniform_draw(row: Sequence[Column | str], label: str, key: bytes) -> Column:
    """Uniform number in (0, 1), one per row, from the same keyed bits."""

    @F.pandas_udf(T.DoubleType())
    def draw(row: pd.Series) -> pd.Series:
        # The half step keeps the draw strictly inside (0, 1).
        return pd.Series([(KeyedDraws(key, r).bits(53) + 0.5) / 2.0**53 for r in row], dtype="float64")

    return draw(row_text(f"uniform {label}", row))
