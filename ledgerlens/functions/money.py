"""Exact money arithmetic on BIGINT minor units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.config import MINOR_PER_UNIT


def exact_sum(amount: Column | str) -> Column:
    """Sum of BIGINT amounts that neither overflows at petabyte volume nor depends on task order."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(amount.cast("decimal(20,0)"))


def in_units(minor: Column | str) -> Column:
    """Minor units (BIGINT or DECIMAL) as a DOUBLE number of currency units."""
    minor = F.col(minor) if isinstance(minor, str) else minor
    return minor.cast("double") / F.lit(float(MINOR_PER_UNIT))


def minor_ratio(minor: Column, count: Column) -> Column:
    """Average in currency units: one division of exact integers, then the unit change."""
    return F.try_divide(minor.cast("double"), count.cast("double")) / F.lit(float(MINOR_PER_UNIT))
