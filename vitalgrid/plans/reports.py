"""Analytics over predictions (patient, run) and processed rows (patient).

Both tables may repeat a patient: predictions once per run, processed rows when the
history does. The cohort reports therefore reduce each side to sums and counts per
patient first, in map-side combines, and multiply after the join. The result is that
of joining the rows themselves, but no patient brings more than a few rows to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.config import AGE_BANDS, ALERT_THRESHOLD, TRIAGE_SIZE
from vitalgrid.functions import age_band, is_alert, parse_iso, round_stable
from vitalgrid.session import cut_lineage

TRIAGE_BROADCAST = 10_000  # so many picked rows are broadcast to the processed table
TRIAGE_DETAILS = ("age", "sex", "cholesterol", "blood_pressure", "country")


def _known(column: str) -> Column:
    """NaN tells no more than NULL: it ranks last and stays out of averages."""
    return F.nanvl(column, F.lit(None).cast("double"))


def triage_top_risk(
    predictions: DataFrame, processed: DataFrame, limit: int = TRIAGE_SIZE
) -> DataFrame:
    """Highest risks first, each with its patient's details where there are any.

    A left join keeps every prediction, so only the first ``limit`` predictions can
    reach the result. They are picked before the join (per task, then merged) and, up
    to ``TRIAGE_BROADCAST``, broadcast, so neither table is shuffled. A longer list is
    joined as it is.
    """
    rank = [F.desc_nulls_last(_known("predicted_risk")), F.asc_nulls_last("patient_id")]
    stamped = predictions.select(
        "patient_id",
        F.col("risk").alias("predicted_risk"),
        "risk_status",
        parse_iso(F.col("scored_at")).alias("scored_at"),
    )
    columns = ["patient_id", "predicted_risk", "risk_status", "scored_at", *TRIAGE_DETAILS]
    details = processed.select("patient_id", *TRIAGE_DETAILS)
    top = stamped.orderBy(*rank).limit(limit)
    if limit > TRIAGE_BROADCAST:
        return top.join(details, "patient_id", "left").orderBy(*rank).limit(limit).select(columns)
    top = cut_lineage(top)
    hits = details.join(F.broadcast(top), "patient_id").orderBy(*rank).limit(limit)
    # Top rows without details: those of patients that no hit is about.
    both = hits.withColumn("_hit", F.lit(1)).unionByName(
        top.withColumn("_hit", F.lit(0)), allowMissingColumns=True
    )
    any_hit = F.max("_hit").over(Window.partitionBy("patient_id"))
    found = both.withColumn("_any", any_hit).where("_hit = _any")
    return found.orderBy(*rank).limit(limit).select(columns)


def high_risk_count(predictions: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Predictions whose stored risk is over the threshold."""
    high = predictions.where(is_alert(F.col("risk"), threshold))
    return high.agg(F.count("*").alias("high_risk_count"))


def _risk_per_patient(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("patient_id").agg(
        F.sum(_known("risk")).alias("risk_sum"),
        F.count(_known("risk")).alias("risk_n"),
        F.count("*").alias("records"),
    )


def _sum_n(column: str) -> list[Column]:
    return [F.sum(column).alias(f"{column}_sum"), F.count(column).alias(f"{column}_n")]


def _mean(column: str, times: str, digits: int) -> Column:
    """Average of ``column`` over joined rows, each standing for ``times`` of them."""
    n = F.sum(F.col(f"{column}_n") * F.col(times))
    return round_stable(F.sum(F.col(f"{column}_sum") * F.col(times)) / F.nullif(n, F.lit(0)), digits)


def _patients() -> Column:
    """Joined rows: every record of a patient meets every processed row."""
    return F.sum(F.col("records") * F.col("rows")).cast("bigint").alias("patients")


def risk_by_age_band(predictions: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows are counted per patient and band in one row per patient, so that the join
    reuses the partitioning of the counts; the bands come apart after it."""
    band = age_band(F.col("age"))
    counts = processed.groupBy("patient_id").agg(
        *[F.count_if(band == label).alias(label) for label, _, _ in AGE_BANDS]
    )
    bands = F.array(
        *[F.struct(F.lit(label).alias("age_group"), F.col(f"`{label}`").alias("rows")) for label, _, _ in AGE_BANDS]
    )
    return (
        counts.join(_risk_per_patient(predictions), "patient_id")
        .select("risk_sum", "risk_n", "records", F.inline(bands))
        .where("rows > 0")
        .groupBy("age_group")
        .agg(_mean("risk", "rows", 3).alias("avg_predicted_risk"), _patients())
        .orderBy("age_group")
    )


def risk_by_sleep_bucket(predictions: DataFrame, processed: DataFrame) -> DataFrame:
    """Whole hours of sleep; patients without sleep readings form the last bucket."""
    bucket = F.floor("sleep_hours").cast("bigint").alias("sleep_hours_floor")
    buckets = processed.groupBy("patient_id", bucket).agg(
        *_sum_n("sleep_hours"), F.count("*").alias("rows")
    )
    return (
        buckets.join(_risk_per_patient(predictions), "patient_id")
        .groupBy("sleep_hours_floor")
        .agg(
            _mean("sleep_hours", "records", 2).alias("avg_sleep"),
            _mean("risk", "rows", 3).alias("avg_predicted_risk"),
            _patients(),
        )
        .orderBy(F.asc_nulls_last("sleep_hours_floor"))
    )


def activity_overview(predictions: DataFrame, processed: DataFrame) -> DataFrame:
    """Overall averages of activity, heart rate and risk over matched records."""
    per_patient = processed.groupBy("patient_id").agg(
        *_sum_n("activity_days"), *_sum_n("heart_rate"), F.count("*").alias("rows")
    )
    return per_patient.join(_risk_per_patient(predictions), "patient_id").agg(
        _mean("activity_days", "records", 2).alias("avg_activity_days"),
        _mean("heart_rate", "records", 1).alias("avg_heart_rate"),
        _mean("risk", "rows", 3).alias("avg_predicted_risk"),
    )
