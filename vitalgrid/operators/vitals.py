"""Weekly profile per patient, joined to the history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitalgrid.functions import bp_text, round_stable
from vitalgrid.operators.joins import ROWS_PER_SALT, left_join
from vitalgrid.sources.schemas import HISTORY
from vitalgrid.config import STALE_HISTORY_COLUMNS

# Stale columns under their file and their internal names.
STALE = (*STALE_HISTORY_COLUMNS, *(n for f, n, _ in HISTORY if f in STALE_HISTORY_COLUMNS))


def weekly_vitals(vitals: DataFrame) -> DataFrame:
    """Averages and activity sum over all readings of a patient. The aggregates
    combine before the shuffle, so a patient with very many readings costs no more
    than one row per task."""
    return vitals.groupBy("patient_id").agg(
        round_stable(F.avg("heart_rate"), 0).alias("heart_rate"),
        round_stable(F.avg("bp_systolic"), 0).try_cast("int").alias("bp_s"),
        round_stable(F.avg("bp_diastolic"), 0).try_cast("int").alias("bp_d"),
        round_stable(F.avg("sleep_hours"), 2).alias("sleep_hours"),
        F.sum("physical_activity").cast("bigint").alias("activity_days"),
    )


def with_blood_pressure(weekly: DataFrame) -> DataFrame:
    """Both averages as one text column, in place of the two."""
    return weekly.withColumn("blood_pressure", bp_text(F.col("bp_s"), F.col("bp_d"))).drop(
        "bp_s", "bp_d"
    )


def drop_stale(history: DataFrame) -> DataFrame:
    return history.drop(*STALE)


def processed_health(
    vitals: DataFrame, history: DataFrame, rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """One row per patient with vitals (more if the history repeats the id)."""
    weekly = with_blood_pressure(weekly_vitals(vitals))
    return left_join(weekly, drop_stale(history), "patient_id", rows_per_salt)
