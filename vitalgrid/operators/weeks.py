"""Vitals by calendar week: the readings of seven local days, not of all time.

A reading's instant becomes the wall clock of a time zone; windows are cut on that clock,
so a week with a change of clocks still goes from Monday midnight to Monday midnight. The
same columns serve a table and a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid.functions import round_stable

WEEK = 7
MONDAY = 4  # days from the epoch, a Thursday, to the first Monday
DAY_MICROS = 86_400_000_000


def wall_clock(instant: Column, zone: str) -> Column:
    """The local time of an instant, as a timestamp that shows it when read as UTC."""
    return F.from_utc_timestamp(instant, zone)


def date_of(clock: Column) -> Column:
    """The date on a wall clock, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(clock) / DAY_MICROS).cast("int"))


def reading_states() -> list[Column]:
    """Sums and counts of readings, which add up over tasks, files and batches."""
    means = [c for name in ("heart_rate", "bp_systolic", "bp_diastolic", "sleep_hours") for c in (
        F.sum(F.col(name).cast("double")).alias(f"{name}_sum"), F.count(name).alias(f"{name}_n"))]
    return [*means, F.sum("physical_activity").cast("bigint").alias("activity_days"), F.count("*").alias("readings")]


def states_by_week(vitals: DataFrame, slide: int = WEEK) -> DataFrame:
    """Sums and counts per patient and window of ``clock``, a wall clock column. A window
    begins every ``slide`` days; with less than a week a reading is in several."""
    window = F.window("clock", f"{WEEK} days", f"{slide} days", f"{MONDAY % slide} days")
    return vitals.groupBy("patient_id", window.alias("week")).agg(*reading_states())


def weekly_columns() -> list[Column]:
    """The rounded profile of a window out of its sums."""

    def mean(name: str) -> Column:
        return F.col(f"{name}_sum") / F.nullif(F.col(f"{name}_n"), F.lit(0))

    return [
        round_stable(mean("heart_rate"), 0).alias("heart_rate"),
        round_stable(mean("bp_systolic"), 0).try_cast("int").alias("bp_s"),
        round_stable(mean("bp_diastolic"), 0).try_cast("int").alias("bp_d"),
        round_stable(mean("sleep_hours"), 2).alias("sleep_hours"),
        "activity_days",
        "readings",
    ]


def weekly_vitals_by_week(vitals: DataFrame, zone: str, slide: int = WEEK) -> DataFrame:
    """One row per patient and week (``week_start``, a Monday; with a shorter ``slide``
    every so many days) that has a reading. ``vitals`` has ``ts``, an instant; readings
    without one are in no week."""
    clocked = vitals.where("ts IS NOT NULL").withColumn("clock", wall_clock(F.col("ts"), zone))
    states = states_by_week(clocked, slide)
    return states.select("patient_id", date_of(F.col("week.start")).alias("week_start"), *weekly_columns())


def last_complete_week(weeks: DataFrame, today: Column) -> DataFrame:
    """Of each patient the last week that has ended by ``today``, a date; patients
    without one are left out. Combines before its shuffle, a row per patient and task."""
    done = weeks.where(F.date_add("week_start", 7) <= today)
    row = F.struct(*[F.col(c) for c in weeks.columns if c != "patient_id"])
    return done.groupBy("patient_id").agg(F.max_by(row, "week_start").alias("last")).select("patient_id", "last.*")
