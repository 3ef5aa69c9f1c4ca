"""Triggered scoring of files as they arrive.

The transform is the batch one and keeps no state. Each micro-batch is a run with
folders of its own below the sink: its scored rows, alerts, alert lines and summary. The
run is named by the query and the batch, so a replayed batch replaces what its first
attempt left, and a query with another checkpoint replaces nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from vitalgrid.config import ALERT_THRESHOLD
from vitalgrid.functions import risk_status, round_stable
from vitalgrid.operators import digest
from vitalgrid.operators.scoring import Scorer, alerts
from vitalgrid.session import exists, new_path
from vitalgrid.sources.readers import empty_on_missing_path
from vitalgrid.sources.writers import with_scored_at, write_run

COLUMNS = ("patient_id", "score", "risk", "risk_status", "scored_at")
SCORED = "patient_id string, score double, risk double, risk_status string, scored_at string, run_id string"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: object
) -> DataFrame:
    """New files below ``path``. ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``
    among the options bound a micro-batch."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


#: Folders below the sink, one per report.
REPORTS = ("alerts", "alert_lines", "summary")


def write_reports(scored: DataFrame, path: str, run_id: str, threshold: float, replace: bool) -> None:
    """Alerts, alert lines and summary of one run, each in a folder of its own."""
    found = alerts(scored, threshold)
    write_run(found, f"{path}/alerts", run_id, replace)
    write_run(digest.alert_lines(found), f"{path}/alert_lines", run_id, replace)
    write_run(digest.run_summary(scored, threshold), f"{path}/summary", run_id, replace)


def score_stream(
    source: DataFrame,
    scorer: Scorer,
    sink: str,
    checkpoint: str | None = None,
    threshold: float = ALERT_THRESHOLD,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start scoring ``source`` into runs below ``sink``: once over what is there, or
    again at every interval. The checkpoint lies in the sink unless another is named,
    so a later trigger goes on where this one ends."""
    sink = sink.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        run_id = f"{query}-{batch_id:08d}"
        known = F.col("score").isNotNull()
        rows = with_scored_at(scorer(batch)).withColumns(
            {
                "risk": round_stable(F.col("score"), 6),
                "risk_status": F.when(known, risk_status(F.col("score"), threshold)),
            }
        )
        path = f"{sink}/scored/run_id={run_id}"
        rows.select(*COLUMNS).write.mode("overwrite").parquet(path)
        back = batch.sparkSession.read.parquet(path)
        write_reports(back, sink, run_id, threshold, replace=True)

    writer = source.writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint or f"{sink}/_checkpoint"
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def read_all_rows(spark: SparkSession, sink: str) -> DataFrame:
    """All rows of all runs below ``sink``, those without a score too; none before the
    first run."""
    read = lambda: spark.read.parquet(f"{sink.rstrip('/')}/scored")
    return empty_on_missing_path(spark, read, SCORED)


def read_scored(spark: SparkSession, sink: str) -> DataFrame:
    """All predictions below ``sink``, with their ``run_id``."""
    return read_all_rows(spark, sink).where("score IS NOT NULL")


def score_available(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    scorer: Scorer,
    sink: str | None = None,
    checkpoint: str | None = None,
    fmt: str = "parquet",
    **options: object,
) -> DataFrame:
    """Score all files there are, in micro-batches, and return every scored row. A
    folder that is empty or not there yet gives what was scored before, if anything."""
    sink = sink or new_path(spark, "scored")
    if not exists(spark, path):
        return read_scored(spark, sink)
    source = file_stream(spark, path, schema, fmt, **options)
    query = score_stream(source, scorer, sink, checkpoint)
    query.awaitTermination()
    return read_scored(spark, sink)
