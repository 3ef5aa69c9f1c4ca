"""The pipeline's tables, derived from the test tables.

Vitals come from ``events`` and the history from ``customer`` with its nation and
region. Some patients lack a history (their ids are shifted out of its range), an age or
sleep readings; some stand in the history twice; the history has columns that fresh
vitals replace; and ``dirty`` holds malformed text, so that every branch of the operators
meets data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitalgrid.operators.scoring import logistic, predictions
from vitalgrid.operators.vitals import processed_health
from vitalgrid.session import staged


# The columns read from each test table; a declared schema needs no pass over footers.
SCHEMAS = {
    "events": "event_id bigint, user_id bigint, event_type string, value double, ts timestamp",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Tenths of an hour as whole numbers, divided once, give the double nearest to the decimal.
VITALS = (
    "CASE WHEN user_id % 10 = 3 THEN user_id + 1000000000 ELSE user_id END AS patient_id",
    "value AS heart_rate",
    "100 + event_id % 71 AS bp_systolic",
    "60 + event_id % 61 AS bp_diastolic",
    "CASE WHEN user_id % 29 = 5 THEN NULL ELSE ((3 + user_id % 6) * 10 + event_id % 10) / 10D END AS sleep_hours",
    "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS physical_activity",
)


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*VITALS)


#: Days by which readings are moved, so that a change of clocks falls among them.
SHIFT_DAYS = 70
ZONE = "Europe/Berlin"


def timed_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with their instant, some without."""
    moved = F.timestamp_micros(F.unix_micros("ts") + SHIFT_DAYS * 86_400_000_000)
    known = F.when(F.expr("event_id % 97 <> 13"), moved)
    return table(spark, sf_dir, "events").withColumn("ts", known).selectExpr(*VITALS, "ts")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer")
    # One pass: a customer is listed once or twice.
    twice = "EXPLODE(CASE WHEN c_custkey % 23 = 4 THEN ARRAY(1, 2) ELSE ARRAY(1) END) AS copy"
    return (
        customer.selectExpr("*", twice)
        .join(nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
        .join(region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
        .selectExpr(
            "c_custkey AS patient_id",
            "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 18 + c_custkey % 65 END AS age",
            "CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS sex",
            "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Unhealthy'"
            " WHEN c_mktsegment = 'FURNITURE' THEN 'Healthy' ELSE 'Average' END AS diet",
            "c_acctbal AS cholesterol",
            "n_name AS country",
            "r_name AS continent",
            # Stale: the processed table takes these from the vitals.
            "0D AS heart_rate",
            "'1/1' AS blood_pressure",
            "0D AS sleep_hours",
            "CAST(0 AS BIGINT) AS activity_days",
            "1 AS heart_attack_risk",
        )
    )


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_health(vitals(spark, sf_dir), history(spark, sf_dir))


def with_gaps(scored_table: DataFrame) -> DataFrame:
    """Some scores NULL, some NaN."""
    gap = "CASE patient_id % 7 WHEN 1 THEN NULL WHEN 2 THEN DOUBLE('NaN') ELSE score END"
    return scored_table.withColumn("score", F.expr(gap))


def linear_scorer(df: DataFrame) -> DataFrame:
    """A fixed logistic score, which SQL can compute as well."""
    z = F.expr(
        "-2D + 0.02D * heart_rate + 0.1D * COALESCE(sleep_hours, 0D)"
        " + CASE WHEN LOWER(sex) = 'male' THEN 0.3D ELSE 0D END - 0.01D * activity_days"
    )
    return df.withColumn("score", logistic(z))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear_scorer(processed(spark, sf_dir)).select("patient_id", "score")


def with_fixed_stamp(df: DataFrame) -> DataFrame:
    second = "LPAD(CAST(patient_id % 60 AS STRING), 2, '0')"
    return df.withColumn("scored_at", F.expr(f"CONCAT('2025-11-24T01:04:', {second}, 'Z')"))


def predicted(processed_table: DataFrame) -> DataFrame:
    rows = predictions(linear_scorer(processed_table).select("patient_id", "score"))
    return with_fixed_stamp(rows).select("patient_id", "risk", "risk_status", "scored_at")


def report_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Predictions and processed rows over one written table, as in production, so
    that the readings are aggregated once and not once per side of the join."""
    once = staged(processed(spark, sf_dir), "processed")
    return predicted(once), once


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS patient_id",
        "CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '120' WHEN 2 THEN 'abc/80'"
        " WHEN 3 THEN '120/80/x' WHEN 4 THEN ' 118 / 77 ' ELSE '131/85' END AS bp",
        "CASE c_custkey % 5 WHEN 0 THEN 'oops' WHEN 1 THEN '' WHEN 2 THEN NULL"
        " ELSE CAST(c_acctbal AS STRING) END AS cholesterol_txt",
        "CASE c_custkey % 3 WHEN 0 THEN 'MALE' WHEN 1 THEN 'Female' ELSE NULL END AS sex",
        "CASE c_custkey % 4 WHEN 0 THEN 'healthy' WHEN 1 THEN 'Unhealthy'"
        " WHEN 2 THEN 'Average' ELSE NULL END AS diet",
        "CASE WHEN c_acctbal > 6000 THEN 1 ELSE 0 END AS label",
    )


def multiplicative_order(key: Column) -> Column:
    """``key * 2654435761 mod 2^32``, in two halves so that no product overflows."""
    factor, half, whole = F.lit(2654435761), F.lit(1 << 16), F.lit(1 << 32)
    k = F.pmod(key, whole)
    low, high = k % half, F.shiftright(k, 16)
    return (low * factor + high * factor % half * half) % whole
