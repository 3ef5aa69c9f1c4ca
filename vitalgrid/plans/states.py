"""The reports kept as states, one small part per run, and merged when asked for.

A run's part holds the sums that each report needs, per group, and its highest risks with
their patients' details. Adding a run reads that run and the processed table; a report
reads parts only. Replacing a run replaces its part, so nothing of the old one remains to
be subtracted, and the highest risks of all runs are among those of the single runs.

Parts follow the processed table as it was when they were made: a new one asks for new
parts. Sums are the same as those of the reports over all rows, up to the order of
addition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitalgrid.config import ALERT_THRESHOLD, TRIAGE_SIZE
from vitalgrid.functions import age_band, is_alert, round_stable
from vitalgrid.plans import reports
from vitalgrid.session import staged
from vitalgrid.sources.readers import empty_on_missing_path

SUMS = ("risk", "sleep_hours", "activity_days", "heart_rate")
#: ``report`` and ``bucket`` name a group; of each value the sum and the count, and the rows.
SCHEMA = ", ".join(["report string, bucket string", *(f"{c}_sum double, {c}_n bigint" for c in SUMS), "patients bigint"])
TOP = "patient_id bigint, predicted_risk double, risk_status string, scored_at timestamp, age int, sex string, cholesterol double, blood_pressure string, country string"


def _known(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def run_states(predictions: DataFrame, processed: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """The sums of one run: per report and group one row. Rows are joined once."""
    details = processed.select("patient_id", "age", "sleep_hours", "activity_days", "heart_rate")
    joined = predictions.select("patient_id", "risk").join(details, "patient_id")
    groups = {
        "age": age_band(F.col("age")),
        "sleep": F.floor("sleep_hours").cast("string"),
        "overall": F.lit(None).cast("string"),
    }
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("report"), b.alias("bucket")) for r, b in groups.items()])).alias("g")
    sums = [x for c in SUMS for x in (F.sum(_known(c)).alias(f"{c}_sum"), F.count(_known(c)).alias(f"{c}_n"))]
    cohorts = joined.select("*", each).groupBy("g.report", "g.bucket").agg(*sums, F.count("*").alias("patients"))
    high = predictions.where(is_alert(F.col("risk"), threshold)).agg(F.lit("high").alias("report"), F.count("*").alias("patients"))
    return cohorts.unionByName(high, allowMissingColumns=True)


def add_run(spark: SparkSession, path: str, run_id: str, predictions: DataFrame, processed: DataFrame, limit: int = TRIAGE_SIZE) -> None:
    """Write the part of a run, in place of an earlier one."""
    parts = run_states(predictions, processed).select([c.strip().split(" ")[0] for c in SCHEMA.split(",")])
    parts.coalesce(1).write.mode("overwrite").parquet(f"{path}/states/run_id={run_id}")
    top = reports.triage_top_risk(predictions, processed, limit)
    top.coalesce(1).write.mode("overwrite").parquet(f"{path}/top/run_id={run_id}")


def _merged(spark: SparkSession, path: str) -> DataFrame:
    """All parts added up: a row per report and group."""
    parts = empty_on_missing_path(spark, lambda: spark.read.schema(f"{SCHEMA}, run_id string").parquet(f"{path}/states"), f"{SCHEMA}, run_id string")
    sums = [F.sum(c).alias(c) for c in parts.columns if c not in ("report", "bucket", "run_id")]
    return parts.groupBy("report", "bucket").agg(*sums)


def _mean(c: str, digits: int) -> Column:
    return round_stable(F.col(f"{c}_sum") / F.nullif(F.col(f"{c}_n"), F.lit(0)), digits)


def reports_from_states(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The cohort reports and the count, by name, out of the parts."""
    merged = staged(_merged(spark, path), "states")
    of = lambda report: merged.where(F.col("report") == report)
    high = of("high").agg(F.coalesce(F.sum("patients"), F.lit(0)).alias("high_risk_count"))
    age = of("age").select(F.col("bucket").alias("age_group"), _mean("risk", 3).alias("avg_predicted_risk"), "patients")
    sleep = of("sleep").select(
        F.col("bucket").cast("bigint").alias("sleep_hours_floor"), _mean("sleep_hours", 2).alias("avg_sleep"),
        _mean("risk", 3).alias("avg_predicted_risk"), "patients",
    )
    whole = of("overall").select(
        _mean("activity_days", 2).alias("avg_activity_days"), _mean("heart_rate", 1).alias("avg_heart_rate"), _mean("risk", 3).alias("avg_predicted_risk")
    )
    return {
        "high_risk_count": high,
        "risk_by_age_band": age.orderBy("age_group"),
        "risk_by_sleep_bucket": sleep.orderBy(F.asc_nulls_last("sleep_hours_floor")),
        "activity_overview": whole,
    }


def triage_from_states(spark: SparkSession, path: str, limit: int = TRIAGE_SIZE) -> DataFrame:
    """The highest risks of all runs, out of those kept for each. ``limit`` is at most
    that of ``add_run``."""
    top = empty_on_missing_path(spark, lambda: spark.read.parquet(f"{path}/top"), f"{TOP}, run_id string").drop("run_id")
    return top.orderBy(F.desc_nulls_last(_known("predicted_risk")), F.asc_nulls_last("patient_id")).limit(limit)


def as_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Several reports as one table: report, group, figure, value."""
    rows = []
    for name, table in tables.items():
        keys = [c for c in ("age_group", "sleep_hours_floor") if c in table.columns]
        group = F.col(keys[0]).cast("string") if keys else F.lit(None).cast("string")
        figures = [F.struct(F.lit(c).alias("figure"), F.col(c).cast("double").alias("value")) for c in table.columns if c not in keys]
        rows.append(table.select(F.lit(name).alias("report"), group.alias("bucket"), F.inline(F.array(*figures))))
    return reduce(DataFrame.unionByName, rows)
