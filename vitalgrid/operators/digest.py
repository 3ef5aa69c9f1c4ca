"""Alert messages and the summary of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitalgrid import config as C
from vitalgrid.functions import is_alert
from vitalgrid.operators.numbering import number_rows


def alert_lines(alerts: DataFrame) -> DataFrame:
    """``n``, ``alerts``, ``line``: one row per alert in the order of the ids, with the
    number of all alerts. This is the form that any number of alerts fits."""
    numbered = number_rows(alerts, ["patient_id"], "n", total="alerts")
    line = F.concat(
        F.col("patient_id").cast("string"), F.lit(": "), F.col("risk_score").cast("string")
    )
    return numbered.select("n", "alerts", line.alias("line"))


def alert_messages(lines: DataFrame, per_message: int | None) -> DataFrame:
    """The lines as message texts, after a line with their number. With ``per_message``
    further lines go on in further messages; None makes one message, which one task
    gathers whole. There is no message without alerts."""
    page = F.lit(0) if per_message is None else F.floor((F.col("n") - 1) / per_message)
    pages = lines.groupBy(page.cast("long").alias("page"), "alerts").agg(
        F.sort_array(F.collect_list(F.struct("n", "line"))).alias("e")
    )
    header = F.when(
        F.col("page") == 0, F.concat(F.col("alerts").cast("string"), F.lit(C.ALERT_HEADER + "\n"))
    ).otherwise("")
    body = F.array_join(F.transform("e", lambda x: x.line), "\n")
    subject = F.lit(C.ALERT_SUBJECT).alias("subject")
    return pages.select("page", "alerts", subject, F.concat(header, body).alias("message"))


def run_summary(scored: DataFrame, threshold: float = C.ALERT_THRESHOLD) -> DataFrame:
    """One row: rows read, rows with a score, alerts. Details stay in tables."""
    alert = F.when(is_alert(F.col("score"), threshold), 1).otherwise(0)
    return scored.agg(
        F.count("*").alias("processed_rows"),
        F.count("score").alias("scored_rows"),
        F.coalesce(F.sum(alert), F.lit(0)).cast("bigint").alias("alerts_triggered"),
    )


def no_input_summary(spark: SparkSession) -> DataFrame:
    """What a run reports when it finds no file to score."""
    return spark.range(1).select(
        F.lit(C.NO_INPUT_STATUS).alias("status"), F.lit(C.NO_INPUT_ERROR).alias("error")
    )
