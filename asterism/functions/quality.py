"""Completeness percentage and its label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to two places, half up, and 0 when ``whole`` is 0."""
    share = part.cast("decimal(20,0)") * 100 / F.nullif(whole.cast("decimal(20,0)"), F.lit(0))
    return F.coalesce(F.round(share, 2), F.lit(0)).cast("decimal(5,2)")


def quality_label(part: Column, whole: Column, threshold: int = 90) -> Column:
    """``Good`` when more than ``threshold`` percent are there, compared before rounding."""
    return F.when((whole > 0) & (part * 100 > whole * threshold), "Good").otherwise("Bad")
