"""Small numeric expressions shared by quality checks, metrics and alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicktide.settings import ROBUST_Z_SCALE, SEVERITY_WEIGHTS, UNKNOWN_SEVERITY_WEIGHT


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, null when the denominator is 0 or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def robust_z(x: Column, median: Column, mad: Column) -> Column:
    """Robust z-score; 0 when the spread is 0 or unknown."""
    return F.when((mad == 0) | mad.isNull(), F.lit(0.0)).otherwise(
        F.lit(ROBUST_Z_SCALE) * (x - median) / mad
    )


def ladder(*steps: tuple[Column, str], default: str) -> Column:
    """Severity of the first condition that holds."""
    out = None
    for condition, severity in steps:
        out = F.when(condition, severity) if out is None else out.when(condition, severity)
    return F.lit(default) if out is None else out.otherwise(default)


def penalty(severity: Column, passed: Column) -> Column:
    """Score points a result costs."""
    out = F.when(passed, F.lit(0))
    for name, weight in SEVERITY_WEIGHTS.items():
        out = out.when(severity == name, F.lit(weight))
    return out.otherwise(F.lit(UNKNOWN_SEVERITY_WEIGHT))


def share_of(part: Column, condition: Column, floor: float = 1.0) -> Column:
    """Share of a sum that meets a condition; the whole is floored so it is never 0."""
    chosen = F.sum(F.when(condition, part).otherwise(0))
    return chosen / F.greatest(F.coalesce(F.sum(part), F.lit(0)), F.lit(floor))


def mentions(text: Column, pattern: str) -> Column:
    """Case-insensitive pattern match; null is no match."""
    return F.coalesce(F.lower(text).rlike(pattern), F.lit(False))
