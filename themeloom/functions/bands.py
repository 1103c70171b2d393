"""Threshold bands used by the checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from themeloom.functions import fixed


def saturation_status(rolling_mean: Column) -> Column:
    return (
        F.when(rolling_mean.isNull(), "insufficient")
        .when(rolling_mean >= fixed.SATURATION_FAR, "far")
        .when(rolling_mean >= fixed.SATURATION_TRENDING, "trending")
        .otherwise("near")
    )


def gap_band(unmatched: Column, total: Column) -> Column:
    """Compare counts, not a rounded ratio, so that exact 10 % and 20 % fall on the right side."""
    return (
        F.when(total == 0, "none")
        .when(unmatched * 100 < total * round(fixed.GAP_OTHER_BELOW * 100), "other_or_ignore")
        .when(unmatched * 100 > total * round(fixed.GAP_ITERATE_ABOVE * 100), "iterate_codebook")
        .otherwise("review")
    )


def gold_band(agreeing: Column, total: Column) -> Column:
    return (
        F.when(total == 0, "none")
        .when(agreeing * 100 >= total * round(fixed.GOLD_STABLE * 100), "stable")
        .when(agreeing * 100 >= total * round(fixed.GOLD_MILD * 100), "mild_drift")
        .otherwise("severe_drift")
    )


def share(part: Column, total: Column) -> Column:
    """part / total as a double, 0 for an empty total (ANSI division by zero raises)."""
    return F.when(total > 0, part.cast("double") / total).otherwise(F.lit(0.0))
