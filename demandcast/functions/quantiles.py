"""Quantile-column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_lower(c: Column, lower: float = 0.0) -> Column:
    """Clamp below at ``lower``; null and NaN pass through unchanged.

    ``greatest(c, 0)`` would turn null into 0, so a CASE is used instead.
    """
    return F.when(c < F.lit(lower), F.lit(float(lower))).otherwise(c)


def half_blend(a: Column, b: Column) -> Column:
    """0.5*a + 0.5*b with a missing side counted as 0 (one-sided rows halve)."""
    return F.lit(0.5) * F.coalesce(a, F.lit(0.0)) + F.lit(0.5) * F.coalesce(b, F.lit(0.0))
