"""Which input files have been scored.

The ledger is a table beside the runs with a folder per run: path, length and time of
every file the run has read. A file counts as new while no row agrees with it in all
three, so a replaced file is new again. Before it is read a file is claimed, by a small
file whose creation succeeds for one of several callers only; the run's mark names its
claims, so that recovery gives them back.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from vitalgrid.session import create_exclusive
from vitalgrid.sources.readers import LISTING, empty_on_missing_path
from vitalgrid.sources.runs import Run, unfinished

FOLDER = "_ledger"
SCHEMA = "path string, length bigint, modified timestamp"
KEY = ["path", "length", "modified"]


def listing(spark: SparkSession, path: str) -> DataFrame:
    """CSV files below ``path``; their contents are not read."""
    files = lambda: spark.read.format("binaryFile").options(**LISTING).load(path)
    found = empty_on_missing_path(spark, files, "path string, length bigint, modificationTime timestamp")
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def folder_of(base: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/{FOLDER}/run_id={run_id}"


def entries(spark: SparkSession, base: str) -> DataFrame:
    """All rows of finished runs, with their ``run_id``."""
    schema = f"{SCHEMA}, run_id string"
    read = lambda: spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{FOLDER}")
    rows = empty_on_missing_path(spark, read, schema)
    open_runs = sorted(unfinished(spark, base))
    return rows.where(~F.col("run_id").isin(open_runs)) if open_runs else rows


def new_files(spark: SparkSession, path: str, base: str) -> DataFrame:
    """Files below ``path`` that no finished run has scored as they are now."""
    return listing(spark, path).join(entries(spark, base).select(KEY), KEY, "left_anti")


def _claim_of(base: str, file: Row) -> str:
    name = hashlib.sha256(f"{file.path}|{file.length}|{file.modified.isoformat()}".encode()).hexdigest()
    return f"{base.rstrip('/')}/{FOLDER}/_claims/{name}"


def claim(run: Run, files: DataFrame) -> list[Row]:
    """Those of ``files`` that no other run has claimed. The paths pass through the
    driver, as the reader needs them there."""
    wanted = {_claim_of(run.base, f): f for f in files.select(KEY).collect()}
    run.claims = sorted(wanted)
    run.mark()
    return [wanted[c] for c in run.claims if create_exclusive(run.spark, c, run.run_id)]


def record(run: Run, files: list[Row]) -> None:
    """Rows of the files a run has scored; one of the run's folders."""
    rows = run.spark.createDataFrame([tuple(f) for f in files], SCHEMA)
    rows.coalesce(1).write.mode("overwrite").parquet(folder_of(run.base, run.run_id))
