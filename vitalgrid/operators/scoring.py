"""From features to predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid.config import ALERT_THRESHOLD, ID_COLUMN
from vitalgrid.functions import is_alert, risk_status, round_stable
from vitalgrid.operators.numbering import number_rows

# Takes a table and returns it with a double column ``score``.
Scorer = Callable[[DataFrame], DataFrame]


def logistic(linear: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-linear))


def with_fallback_id(df: DataFrame, order: list[str], column: str = ID_COLUMN) -> DataFrame:
    """``Row1``, ``Row2``, ... by ``order``, only where the id column is absent."""
    if column in df.columns:
        return df
    numbered = number_rows(df, order, "_n")
    return numbered.withColumn(column, F.concat(F.lit("Row"), F.col("_n").cast("string"))).drop("_n")


def row_cap(df: DataFrame, order: list[str], max_rows: int | None) -> DataFrame:
    """First ``max_rows`` rows by ``order``; everything when no cap is set."""
    return df if max_rows is None else df.orderBy(*order).limit(max_rows)


def predictions(scored: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Stored risk and status. The status looks at the raw score, the stored risk is
    rounded; rows without a score are left out."""
    return scored.where("score IS NOT NULL").withColumns(
        {
            "risk": round_stable(F.col("score"), 6),
            "risk_status": risk_status(F.col("score"), threshold),
        }
    )


def alerts(scored: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Patients whose raw score is over the threshold."""
    return scored.where(is_alert(F.col("score"), threshold)).select(
        "patient_id",
        round_stable(F.col("score"), 3).alias("risk_score"),
        risk_status(F.col("score"), threshold).alias("status"),
    )
