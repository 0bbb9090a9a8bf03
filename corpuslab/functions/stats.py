"""Tail probabilities for test statistics, one value per group."""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

EXACT_PAIRS = 50
EXACT_SMALLER = 8


def normal_two_sided(z: float) -> float:
    return min(1.0, math.erfc(abs(z) / math.sqrt(2)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated bottom up."""
    value = 1.0
    for m in range(200, 0, -1):
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        value = 1 + even / (1 + odd / value)
    return 1 / (1 - (a + b) * x / ((a + 1) * value))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def t_upper_tail(t: float, freedom: float) -> float:
    """P(T > t) for t >= 0."""
    return incomplete_beta(freedom / 2, 0.5, freedom / (freedom + t * t)) / 2


def t_quantile(probability: float, freedom: int) -> float:
    """The t with P(T <= t) = probability, for probability above one half."""
    low, high = 0.0, 1.0
    while t_upper_tail(high, freedom) > 1 - probability:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if t_upper_tail(middle, freedom) > 1 - probability:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def signed_rank_tails(pairs: int) -> np.ndarray:
    """Probability of each signed-rank sum or a smaller one, without ties."""
    ways = np.zeros(pairs * (pairs + 1) // 2 + 1)
    ways[0] = 1
    for rank in range(1, pairs + 1):
        ways[rank:] += ways[:-rank].copy()
    return np.cumsum(ways) / 2.0**pairs


def signed_rank_exact(pairs: int, statistic: float) -> float:
    """Two-sided p of the signed-rank statistic without ties."""
    return min(1.0, 2 * float(signed_rank_tails(pairs)[int(statistic)]))


@cache
def bounded_parts(largest: int) -> tuple[int, list[int]]:
    """A period and a polynomial that give ``parts_up_to``.

    The series 1 / ((1 - q)(1 - q)(1 - q^2) ... (1 - q^largest)) is the polynomial
    over (1 - q^period)^(largest + 1), the period a multiple of all exponents.
    """
    period = math.lcm(*range(1, largest + 1))
    terms = [1]
    for k in [1, *range(1, largest + 1)]:
        # Times (1 - q^period) / (1 - q^k) = 1 + q^k + ... + q^(period - k).
        longer = terms + [0] * (period - k)
        for i in range(k, len(longer)):
            longer[i] += longer[i - k] - (terms[i - period] if i >= period else 0)
        terms = longer
    return period, terms


def parts_up_to(largest: int, total: int) -> int:
    """Ways to add parts from 1 to ``largest`` to ``total`` or less."""
    period, terms = bounded_parts(largest)
    return sum(
        terms[at] * math.comb((total - at) // period + largest, largest)
        for at in range(total % period, min(total + 1, len(terms)), period)
    )


def rank_sum_ways(smaller: int, larger: int, u: int) -> int:
    """Arrangements of two samples without ties whose U is at most ``u``.

    U counts parts in a box of ``smaller`` by ``larger``: parts of any number,
    less those that pass the box, by inclusion and exclusion over the factors
    1 - q^(larger + k). Time and memory do not depend on ``larger``.
    """
    signed = {0: 1}
    for k in range(1, smaller + 1):
        for shift, sign in list(signed.items()):
            if shift + larger + k <= u:
                signed[shift + larger + k] = signed.get(shift + larger + k, 0) - sign
    return sum(sign * parts_up_to(smaller, u - shift) for shift, sign in signed.items() if sign)


def rank_sum_exact(first: int, second: int, larger_u: float) -> float:
    """Two-sided p of the larger U of two samples without ties, the smaller one
    of about ten values at most."""
    below = math.floor(first * second - larger_u)
    if below < 0:
        return 0.0
    if 2 * below >= first * second:
        return 1.0
    smaller, larger = min(first, second), max(first, second)
    return min(1.0, 2 * rank_sum_ways(smaller, larger, below) / math.comb(first + second, smaller))


@F.pandas_udf(T.DoubleType())
def rank_sum_p(n_a: pd.Series, n_b: pd.Series, u_a: pd.Series, z: pd.Series, tied: pd.Series) -> pd.Series:
    """Exact if one sample is tiny and there are no ties, else the normal tail of
    ``z``."""

    def one(a: float, b: float, u: float, score: float, has_ties: bool) -> float:
        if min(a, b) <= EXACT_SMALLER and not has_ties:
            return rank_sum_exact(int(a), int(b), max(u, a * b - u))
        return 1.0 if math.isnan(score) else min(1.0, math.erfc(score / math.sqrt(2)))

    return pd.Series([one(*row) for row in zip(n_a, n_b, u_a, z, tied)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def signed_rank_p(pairs: pd.Series, statistic: pd.Series, z: pd.Series, tied: pd.Series) -> pd.Series:
    """Exact for up to 50 pairs without ties, else the normal tail of ``z``."""
    found: dict[int, np.ndarray] = {}

    def one(m: float, w: float, score: float, has_ties: bool) -> float:
        if m > EXACT_PAIRS or has_ties:
            return normal_two_sided(score)
        if m not in found:
            found[m] = signed_rank_tails(int(m))
        return min(1.0, 2 * float(found[m][int(w)]))

    return pd.Series([one(*row) for row in zip(pairs, statistic, z, tied)], dtype="float64")


def t_quantile_of(level: float):
    """A function from sample sizes to two-sided t-quantiles with one degree less."""

    @F.pandas_udf(T.DoubleType())
    def quantile(size: pd.Series) -> pd.Series:
        found = {n: t_quantile((1 + level) / 2, int(n) - 1) if n > 1 else float("nan") for n in size.unique()}
        return size.map(found).astype("float64")

    return quantile
