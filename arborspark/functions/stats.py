"""P-values from aggregated test statistics.

The statistics themselves are Spark aggregates; what is left here works on one
row of totals.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT_SIGNED_RANK_N = 50
EXACT_RANK_SUM_N = 8


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _signed_rank_counts(n: int) -> list[int]:
    """Number of sign patterns per positive rank sum."""
    ways = [1] + [0] * (n * (n + 1) // 2)
    for rank in range(1, n + 1):
        for total in range(len(ways) - 1, rank - 1, -1):
            ways[total] += ways[total - rank]
    return ways


def signed_rank_p(n: int, w_plus: float, w_minus: float, tie_term: float, zeros: int = 0) -> float:
    """Two-sided Wilcoxon signed-rank p-value; ``zeros`` differences were dropped.

    Exact for at most 50 untied differences none of which was zero, otherwise
    the normal approximation with tie correction.
    """
    if n == 0:
        return 1.0
    low = min(w_plus, w_minus)
    if n <= EXACT_SIGNED_RANK_N and tie_term == 0 and zeros == 0:
        ways = _signed_rank_counts(n)
        return min(1.0, 2.0 * sum(ways[: int(low) + 1]) / 2.0**n)
    mean = n * (n + 1) / 4.0
    var = n * (n + 1) * (2 * n + 1) / 24.0 - tie_term / 48.0
    return normal_two_sided((low - mean) / math.sqrt(var)) if var > 0 else 1.0


def _rank_sum_tail(few: int, many: int, most: int) -> int:
    """Arrangements whose U is at most ``most``: leading terms of a Gaussian binomial."""
    ways = [1] + [0] * most
    for i in range(1, few + 1):
        for u in range(most, many + i - 1, -1):
            ways[u] -= ways[u - many - i]
        for u in range(i, most + 1):
            ways[u] += ways[u - i]
    return sum(ways)


def rank_sum_p(n1: int, n2: int, u: float, tie_term: float) -> float:
    """Two-sided Mann-Whitney p-value; exact if untied and the smaller sample is
    small, otherwise normal with tie and continuity correction."""
    if n1 == 0 or n2 == 0:
        return float("nan")
    high = max(u, n1 * n2 - u)
    if tie_term == 0 and min(n1, n2) <= EXACT_RANK_SUM_N:
        tail = _rank_sum_tail(min(n1, n2), max(n1, n2), n1 * n2 - int(high))
        return min(1.0, 2 * tail / math.comb(n1 + n2, n1))
    n = n1 + n2
    var = n1 * n2 / 12.0 * ((n + 1) - tie_term / (n * (n - 1)))
    if var <= 0:
        return 1.0
    z = (high - n1 * n2 / 2.0 - 0.5) / math.sqrt(var)
    return min(1.0, max(0.0, math.erfc(z / math.sqrt(2.0))))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction 1 + d1 / (1 + d2 / (1 + ...)) of the incomplete beta function, from the front."""
    value, c, d = 1.0, 1.0, 0.0
    for step in range(1, 100_000):
        m, odd = divmod(step, 2)
        if odd:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / (1.0 + term * d)
        c = 1.0 + term / c
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front / _beta_fraction(a, b, x) / a


def correlation_p(n: int, rho: float) -> float:
    """Two-sided p-value of a correlation by the t distribution with n - 2 degrees of freedom."""
    if n < 3 or abs(rho) >= 1:
        return 0.0 if abs(rho) >= 1 else float("nan")
    return incomplete_beta((n - 2) / 2, 0.5, 1 - rho * rho)


@F.pandas_udf(T.DoubleType())
def signed_rank_p_col(n: pd.Series, w_plus: pd.Series, w_minus: pd.Series, tie_term: pd.Series, zeros: pd.Series) -> pd.Series:
    return pd.Series([signed_rank_p(int(a), b, c, d, int(e)) for a, b, c, d, e in zip(n, w_plus, w_minus, tie_term, zeros)], dtype=float)


@F.pandas_udf(T.DoubleType())
def rank_sum_p_col(n1: pd.Series, n2: pd.Series, u: pd.Series, tie_term: pd.Series) -> pd.Series:
    return pd.Series([rank_sum_p(int(a), int(b), c, d) for a, b, c, d in zip(n1, n2, u, tie_term)], dtype=float)


@F.pandas_udf(T.DoubleType())
def correlation_p_col(n: pd.Series, rho: pd.Series) -> pd.Series:
    return pd.Series([correlation_p(int(a), b) for a, b in zip(n, rho)], dtype=float)
