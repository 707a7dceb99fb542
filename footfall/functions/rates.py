"""Rates turned into probabilities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def at_least_one(rate: Column, periods: float = 1.0) -> Column:
    """Chance of one or more arrivals in ``periods`` for a Poisson rate per period."""
    return F.lit(1.0) - F.exp(-(rate * F.lit(float(periods))))


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
