"""Weekly vitals kept up to date while readings arrive.

The state is one row of sums and counts per patient and week, held by Spark's state
store until the watermark has passed the week's end. Each micro-batch yields the rows
that it changed; they are written as a version of their own, named by the batch, so a
replayed batch replaces what its first attempt left. The table is the newest version of
each patient and week; ``compact`` folds the versions into one.

A reading that is later than ``delay`` behind the newest one finds its week closed and is
left out, as Spark's metric of rows dropped by the watermark tells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vitalgrid.operators.weeks import date_of, states_by_week, wall_clock, weekly_columns
from vitalgrid.session import delete, list_folder

KEY = ["patient_id", "week_start"]


def _version(batch_id: int) -> str:
    return f"version={batch_id:012d}"


def keep_weekly(
    source: DataFrame, sink: str, zone: str, delay: str = "14 days", available_now: bool = True, interval: str = "1 minute"
) -> StreamingQuery:
    """Start adding the readings of ``source`` (with ``ts``) up below ``sink``. The
    checkpoint lies there too, so a later trigger goes on where this one ends."""
    sink = sink.rstrip("/")
    clocked = source.withColumn("clock", wall_clock(F.col("ts"), zone)).withWatermark("clock", delay)
    states = states_by_week(clocked)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("week_start", date_of(F.col("week.start"))).drop("week")
        rows.write.mode("overwrite").parquet(f"{sink}/states/{_version(batch_id)}")

    writer = states.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{sink}/_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_states(spark: SparkSession, sink: str) -> DataFrame:
    """The newest sums of each patient and week. A row per key and task is shuffled."""
    rows = spark.read.option("basePath", f"{sink}/states").parquet(f"{sink}/states")
    value = F.struct(*[F.col(c) for c in rows.columns if c not in (*KEY, "version")])
    return rows.groupBy(*KEY).agg(F.max_by(value, "version").alias("v")).select(*KEY, "v.*")


def read_weekly(spark: SparkSession, sink: str) -> DataFrame:
    """The rounded profiles, as ``weekly_vitals_by_week`` gives them."""
    return read_states(spark, sink.rstrip("/")).select(*KEY, *weekly_columns())


def compact(spark: SparkSession, sink: str) -> None:
    """Fold all versions into the newest; while no stream writes. The folded rows are
    whole beside the versions before these go, and agree with them, so a reader or a
    second attempt after a failure sees the same table."""
    sink = sink.rstrip("/")
    versions = [e for e in list_folder(spark, f"{sink}/states") if e.is_folder and e.name.startswith("version=")]
    if len(versions) < 2:
        return
    newest = int(versions[-1].name.split("=")[1])
    # Behind the newest version and before the next batch's.
    folded = f"{sink}/states/version={newest:012d}.5"
    read_states(spark, sink).write.mode("overwrite").parquet(folded)
    for e in versions:
        if e.path.rstrip("/").rsplit("/", 1)[1] != folded.rsplit("/", 1)[1]:
            delete(spark, e.path)
