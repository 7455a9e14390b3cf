"""Closed-form statistics over already aggregated columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; NULL for an empty whole."""
    return part * F.lit(100.0) / F.when(whole != 0, whole)


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 for an empty whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def k_squared(n: Column, skewness: Column, excess_kurtosis: Column) -> Column:
    """D'Agostino-Pearson omnibus statistic from population moments (needs n >= 8).

    Sum of the squared normal scores of the sample skewness (D'Agostino 1970) and the
    sample kurtosis (Anscombe & Glynn 1983). A skewness of exactly zero scores zero: special
    treatment of that single value would make the result hang on rounding noise.
    """
    n = n.cast("double")
    return F.pow(_skewness_score(n, skewness), 2) + F.pow(_kurtosis_score(n, excess_kurtosis), 2)


def k_squared_p_value(statistic: Column) -> Column:
    """Upper tail of chi-squared with two degrees of freedom."""
    return F.exp(-statistic / 2)


def _skewness_score(n: Column, g1: Column) -> Column:
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = (
        3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)
        / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    )
    w2 = F.sqrt(2 * (beta - 1)) - 1
    delta = 1 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2 / (w2 - 1))
    return delta * F.asinh(y / alpha)


def _kurtosis_score(n: Column, g2: Column) -> Column:
    expected = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (g2 + 3 - expected) / F.sqrt(variance)
    skew = (
        6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
        * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = 6 + (8 / skew) * (2 / skew + F.sqrt(1 + 4 / (skew * skew)))
    d = 1 + x * F.sqrt(2 / (a - 4))
    root = F.signum(d) * F.pow((1 - 2 / a) / F.abs(d), F.lit(1.0 / 3.0))
    return (1 - 2 / (9 * a) - root) / F.sqrt(2 / (9 * a))
