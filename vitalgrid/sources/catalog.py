"""Database, external tables and the one SQL function Spark does not know by name."""

from __future__ import annotations

from pyspark.sql import SparkSession

from vitalgrid.session import list_folder
from vitalgrid.sources import runs, schemas as S
from vitalgrid.sources.readers import QUOTES

# Names that existing queries use.
DATABASE = "healthcare_analysis_db"
PROCESSED_TABLE = "heart_attack_processed_data"
PREDICTIONS_TABLE = "heart_attack_predictions"

# What the predictions are made of, and where their folder is noted.
RUNS_TABLE, FILES_TABLE = f"{PREDICTIONS_TABLE}_runs", f"{PREDICTIONS_TABLE}_files"
FOLDER_PROPERTY = "vitalgrid.folder"


def register_functions(spark: SparkSession) -> None:
    """``from_iso8601_timestamp`` as a SQL function; Catalyst inlines its body."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION from_iso8601_timestamp(s STRING) "
        "RETURNS TIMESTAMP RETURN try_to_timestamp(s)"
    )


def _create_table(spark: SparkSession, name: str, columns: str, location: str, partitioned: bool = False, **options: str) -> None:
    options = {"header": "true", "enforceSchema": "false", **QUOTES, **options}
    listed = ", ".join(f"{k} '{v}'" for k, v in options.items())
    properties = f"TBLPROPERTIES ('{FOLDER_PROPERTY}' = '{_quoted(location)}')"
    by_run = "PARTITIONED BY (run_id) " if partitioned else ""
    # A path with a pattern is an option; it is no location.
    place = f"OPTIONS ({listed}, path '{_quoted(location)}') " if "*" in location else f"OPTIONS ({listed}) "
    at = "" if "*" in location else f" LOCATION '{_quoted(location)}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING csv {place}{by_run}{properties}{at}")


def _quoted(text: str) -> str:
    return text.replace("'", "\\'")


def _columns(table: S.Table) -> str:
    return ", ".join(f"`{f}` {t}" for f, _, t in table)


def create_catalog(
    spark: SparkSession, processed_path: str, predictions_path: str, database: str = DATABASE, **options: str
) -> None:
    """Create the database and its tables where absent, and use the database.

    The predictions are a view over a table with a partition per finished run, so that
    a query on one run reads no other, and the files that lie in the folder itself,
    whose ``run_id`` is the file's name. A file whose header differs from the declared
    columns is an error. ``options`` are those of the reader, such as ``LINE_FEEDS``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.catalog.setCurrentDatabase(database)
    _create_table(spark, f"`{database}`.`{PROCESSED_TABLE}`", _columns(S.PROCESSED), processed_path, **options)
    _create_table(spark, f"`{database}`.`{RUNS_TABLE}`", f"{_columns(S.PREDICTIONS)}, run_id string", predictions_path, True, **options)
    add_runs(spark, database, **options)
    register_functions(spark)


def add_runs(spark: SparkSession, database: str = DATABASE, **options: str) -> None:
    """Let the predictions see the runs and files written since the last call, and no
    longer those that are gone or not finished."""
    runs_table, files_table, view = (f"`{database}`.`{t}`" for t in (RUNS_TABLE, FILES_TABLE, PREDICTIONS_TABLE))
    folder = spark.sql(f"SHOW TBLPROPERTIES {runs_table} ('{FOLDER_PROPERTY}')").first().value
    found = list_folder(spark, folder)
    unfinished = runs.unfinished(spark, folder)
    there = {e.name[7:]: e.path for e in found if e.is_folder and e.name.startswith("run_id=") and e.name[7:] not in unfinished}
    known = {r.partition[7:] for r in spark.sql(f"SHOW PARTITIONS {runs_table}").collect()}
    for run_id in sorted(known - set(there)):
        spark.sql(f"ALTER TABLE {runs_table} DROP IF EXISTS PARTITION (run_id = '{_quoted(run_id)}')")
    new = [f"PARTITION (run_id = '{_quoted(r)}') LOCATION '{_quoted(there[r])}'" for r in sorted(set(there) - known)]
    if new:
        spark.sql(f"ALTER TABLE {runs_table} ADD IF NOT EXISTS {' '.join(new)}")
    spark.sql(f"REFRESH TABLE {runs_table}")

    columns = ", ".join(f"`{f}`" for f, _, _ in S.PREDICTIONS)
    parts = [f"SELECT {columns}, run_id FROM {runs_table}"]
    spark.sql(f"DROP TABLE IF EXISTS {files_table}")
    if any(not e.is_folder and e.name.endswith(".csv") for e in found):
        _create_table(spark, files_table, _columns(S.PREDICTIONS), f"{folder.rstrip('/')}/*.csv", **options)
        parts.append(f"SELECT {columns}, _metadata.file_name AS run_id FROM {files_table}")
    if spark.catalog.tableExists(f"{database}.{PREDICTIONS_TABLE}") and spark.catalog.getTable(f"{database}.{PREDICTIONS_TABLE}").tableType != "VIEW":
        spark.sql(f"DROP TABLE {view}")  # of an earlier version; its files stay
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {' UNION ALL '.join(parts)}")
