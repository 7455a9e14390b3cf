"""Threshold expressions. A NULL reading never signals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plantwatch.params import Band


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def trend(value: Column, band: Band, size: float = 1.0) -> Column:
    """``+size`` above the band, ``-size`` below it, else 0."""
    return (
        F.when(value > band.high, F.lit(size))
        .when(value < band.low, F.lit(-size))
        .otherwise(F.lit(0.0))
    )


def outside(value: Column, band: Band) -> Column:
    return (value > band.high) | (value < band.low)


def settled(average: Column) -> Column:
    """An average without its rounding noise.

    Sums of doubles depend on the order in which tasks add them, so an average that equals a
    limit exactly could fall on either side of it. Compare this instead of the raw average.
    """
    return F.round(average, 9)


def score(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))
