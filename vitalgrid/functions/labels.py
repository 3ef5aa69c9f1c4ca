"""Labels derived from a score or an age."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vitalgrid.config import AGE_BANDS, ALERT_THRESHOLD, HIGH_RISK, LOW_RISK


def is_alert(score: Column, threshold: float = ALERT_THRESHOLD) -> Column:
    """Strictly over the threshold. Spark orders NaN above every number, so a
    NaN score is kept out by hand."""
    return (score > F.lit(threshold)) & ~F.isnan(score)


def risk_status(score: Column, threshold: float = ALERT_THRESHOLD) -> Column:
    return F.when(is_alert(score, threshold), HIGH_RISK).otherwise(LOW_RISK)


def age_band(age: Column) -> Column:
    """Ten-year bands. The first also takes everyone younger, and the last also
    takes an unknown age."""
    band = F.when(age <= AGE_BANDS[0][2], AGE_BANDS[0][0])
    for label, low, high in AGE_BANDS[1:-1]:
        band = band.when(age.between(low, high), label)
    return band.otherwise(AGE_BANDS[-1][0])
