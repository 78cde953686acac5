"""Privacy budgets as exact rationals, and the running account of what is left."""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

Amount = Fraction | float
"""A finite exact amount, or ``math.inf``."""

ROUNDING = Fraction(1, 10**9)
"""A request above the remainder by at most this share of it is rounded down to the remainder."""


def exact(value: int | float | str | Decimal | Fraction) -> Amount:
    """Exact rational of a number as written (0.1 is one tenth); infinity stays infinity."""
    if isinstance(value, float) and math.isinf(value) and value > 0:
        return math.inf
    amount = value if isinstance(value, Fraction) else Fraction(str(value))
    if amount < 0:
        raise ValueError("a budget must not be negative")
    return amount


@dataclass(frozen=True)
class Pure:
    """Pure differential privacy with ``epsilon``."""

    epsilon: Amount

    def __post_init__(self):
        object.__setattr__(self, "epsilon", exact(self.epsilon))

    @property
    def amounts(self) -> tuple[Amount, ...]:
        return (self.epsilon,)

    kind = "pure"


@dataclass(frozen=True)
class Approximate:
    """(epsilon, delta) differential privacy."""

    epsilon: Amount
    delta: Amount

    def __post_init__(self):
        object.__setattr__(self, "epsilon", exact(self.epsilon))
        object.__setattr__(self, "delta", exact(self.delta))
        if self.delta > 1:
            raise ValueError("delta must not exceed 1")

    @property
    def amounts(self) -> tuple[Amount, ...]:
        return (self.epsilon, self.delta)

    kind = "approximate"


@dataclass(frozen=True)
class Concentrated:
    """Zero-concentrated differential privacy with ``rho``."""

    rho: Amount

    def __post_init__(self):
        object.__setattr__(self, "rho", exact(self.rho))

    @property
    def amounts(self) -> tuple[Amount, ...]:
        return (self.rho,)

    kind = "concentrated"


Budget = Pure | Approximate | Concentrated


def share(budget: Budget, n: int) -> Budget:
    """An n-th of a budget; infinite amounts stay infinite."""
    return type(budget)(*[a / n for a in budget.amounts])


def is_infinite(budget: Budget) -> bool:
    return budget.amounts[0] == math.inf


def _granted(request: Amount, left: Amount) -> Amount:
    if request <= left:
        return request
    if left == math.inf or request == math.inf or request > left * (1 + ROUNDING):
        raise ValueError(f"the request {request} exceeds what is left, {left}")
    return left


class Ledger:
    """What is left of a total budget. Amounts are plain driver-side numbers."""

    def __init__(self, total: Budget):
        self.left = total

    def spend(self, request: Budget) -> Budget:
        """Debit a request and return what was granted (see ``ROUNDING``)."""
        if type(request) is not type(self.left):
            raise ValueError(f"the account holds {self.left.kind} budget, not {request.kind}")
        if request.amounts[0] == 0 and all(a == 0 for a in request.amounts):
            raise ValueError("a query needs a budget above zero")
        granted = [_granted(r, a) for r, a in zip(request.amounts, self.left.amounts)]
        rest = [a if a == math.inf else a - g for a, g in zip(self.left.amounts, granted)]
        self.left = type(self.left)(*rest)
        return type(request)(*granted)
