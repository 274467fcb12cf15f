"""Reproducible Gaussian noise."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _uniform(*parts: Column) -> Column:
    """Uniform in (0, 1) from a hash: 2**53 evenly spaced values, never 0 or 1."""
    return (F.pmod(F.xxhash64(*parts), F.lit(2**53)) + 0.5) / F.lit(float(2**53))


def standard_normal(seed: int, *parts: Column) -> Column:
    """One standard normal draw per distinct ``parts`` (Box-Muller).

    The draw depends on the row's own key only, so a re-run task, another
    partitioning or another cluster size gives the same value.
    """
    radius = F.sqrt(-2.0 * F.log(_uniform(F.lit(seed), F.lit("r"), *parts)))
    return radius * F.cos(2.0 * math.pi * _uniform(F.lit(seed), F.lit("a"), *parts))


def horizon_noise(horizon: Column, seed: int, *parts: Column, first: int = 7) -> Column:
    """Forecast-error stand-in: one more draw is added at every horizon from ``first`` on.

    The sum at horizon ``j`` has variance ``j - first + 1``.
    """
    steps = F.sequence(F.lit(first), F.greatest(horizon, F.lit(first)))
    total = F.aggregate(steps, F.lit(0.0), lambda acc, j: acc + standard_normal(seed, j, *parts))
    return F.when(horizon >= first, total).otherwise(0.0)
