"""CSV and text sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitalgrid.functions import iso_utc, run_stamp
from vitalgrid.sources import runs, schemas as S
from vitalgrid.sources.readers import QUOTES

# Text keeps the space it begins and ends with.
WRITTEN = {**QUOTES, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def one_line(df: DataFrame) -> DataFrame:
    """The same rows; text with a line feed or carriage return is an error while they
    are written. Readers would cut such a row in two unless told to expect it."""

    def checked(name: str):
        c = F.col(f"`{name}`")
        message = F.lit(f"a value of column {name!r} holds a line feed; write and read with line_feeds")
        return F.when(c.rlike("[\\r\\n]"), F.raise_error(message).cast("string")).otherwise(c).alias(name)

    texts = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    return df.select([checked(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def write_processed(df: DataFrame, path: str, single_file: bool = False, line_feeds: bool = False) -> None:
    """Processed table as CSV with a header, replacing what is there. A single
    file runs the last stage in one task, so it is off by default."""
    out = S.to_file_names(df if line_feeds else one_line(df), S.PROCESSED)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).options(**WRITTEN).csv(path)


def write_labelled(df: DataFrame, path: str) -> None:
    """Training rows without a header, in the order of their columns."""
    df.write.mode("overwrite").option("header", False).options(**WRITTEN).csv(path)


def write_feature_list(spark: SparkSession, names: list[str], path: str) -> None:
    """Names joined by newlines in one row, so that their order is kept."""
    text = spark.range(1).select(F.lit("\n".join(names)).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(path)


def new_run_id(spark: SparkSession) -> str:
    """The second of the run, for people, and a suffix that no other run has."""
    stamp = spark.range(1).select(run_stamp(F.current_timestamp()).alias("s")).first().s
    return f"{stamp}_{uuid.uuid4().hex[:12]}"


def with_scored_at(df: DataFrame) -> DataFrame:
    """Stamp rows with the time of the query; one value for the whole run."""
    return df.withColumn("scored_at", iso_utc(F.current_timestamp()))


def write_run(
    df: DataFrame, path: str, run_id: str, replace: bool = False, line_feeds: bool = False
) -> None:
    """CSV with a header in the run's own folder. A run that is there already is an
    error unless it is to be replaced, as by a retry that names its run."""
    mode = "overwrite" if replace else "errorifexists"
    out = (df if line_feeds else one_line(df)).write.mode(mode).option("header", True).options(**WRITTEN)
    out.csv(f"{path.rstrip('/')}/run_id={run_id}")


def prediction_folder(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/run_id={run_id}"


def write_prediction_rows(predictions: DataFrame, path: str, run_id: str, replace: bool = False) -> bool:
    """The predictions of a run that the caller has begun. An empty run writes nothing."""
    if predictions.isEmpty():
        return False
    out = S.to_file_names(predictions.select([n for _, n, _ in S.PREDICTIONS]), S.PREDICTIONS)
    write_run(out, path, run_id, replace)
    return True


def write_predictions(
    predictions: DataFrame, path: str, run_id: str, replace: bool = False
) -> bool:
    """Add one run of predictions alone to the folder. An empty run writes nothing."""
    if predictions.isEmpty():
        return False
    with runs.run(predictions.sparkSession, path, run_id, [prediction_folder(path, run_id)], replace):
        return write_prediction_rows(predictions, path, run_id, replace)
