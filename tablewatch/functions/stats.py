"""Small statistical expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: normal quantile for a 95% two-sided interval.
Z_95 = 1.96


def binomial_lower_bound(p: Column, n: Column, z: float = Z_95) -> Column:
    """``floor(100 * (p - z * sqrt(p (1 - p) / n))) / 100``: a lower bound on a share."""
    p = p.cast("double")
    return F.floor(F.lit(100.0) * (p - F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / n.cast("double")))) / F.lit(100.0)
