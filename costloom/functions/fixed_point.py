"""Order-independent money arithmetic.

A sum of doubles depends on the order in which partitions arrive. Amounts are
therefore added as decimals of ten places, so a total is the same for every
partitioning, and only the total is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 10_000


def to_units(amount: Column, scale: int = SCALE) -> Column:
    """Amount as a whole number of 1/scale units (half rounds up)."""
    return F.floor(amount * F.lit(float(scale)) + F.lit(0.5))


def round_units(amount: Column, scale: int = SCALE) -> Column:
    """Amount rounded to 1/scale, as a double."""
    return to_units(amount, scale).cast("double") / F.lit(float(scale))


def exact_sum(amount: Column, decimals: int = 4) -> Column:
    """Sum that does not depend on row order: addends keep ten decimals, the total is rounded."""
    return F.round(F.sum(amount.cast("decimal(28,10)")), decimals).cast("double")
