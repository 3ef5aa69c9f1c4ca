"""CSV and text sources. No reader infers types, so none scans its input twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vitalgrid.config import TARGET_COLUMN
from vitalgrid.session import list_folder
from vitalgrid.sources import runs, schemas as S


# A quote within a quoted field is doubled.
QUOTES = {"quote": '"', "escape": '"'}
# What ``pick_input`` finds below a folder, as options for whoever reads it.
LISTING = {"pathGlobFilter": "*.csv", "recursiveFileLookup": "true"}


# Lets a quoted field hold line feeds. Off by default: a file is then one task.
LINE_FEEDS = {"multiLine": "true"}


def empty_on_missing_path(spark: SparkSession, read: Callable[[], DataFrame], schema: str | T.StructType) -> DataFrame:
    """What ``read`` gives, or no rows of ``schema`` where there is no such path."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise


def read_rows(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Rows as text, by header name. Every file must carry the same header: a
    differing one is an error instead of values under the wrong name. A quoted field
    with a line feed needs ``LINE_FEEDS`` among the options."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return reader.options(**QUOTES, **options).csv(path)


def _read_table(spark: SparkSession, path: str | list[str], table: S.Table, **options: str) -> DataFrame:
    return S.to_internal_names(S.typed(read_rows(spark, path, **options), table), table)


def read_vitals(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    return _read_table(spark, path, S.VITALS, **options)


def read_history(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    return _read_table(spark, path, S.HISTORY, **options)


def read_training(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Training rows under their file names, which name the features too."""
    return S.typed(read_rows(spark, path, **options), S.HISTORY)


def read_labelled(
    spark: SparkSession, path: str, features: list[str], target: str = TARGET_COLUMN
) -> DataFrame:
    """A training or validation file without a header: the target, then the features."""
    fields = [T.StructField(target, T.IntegerType())]
    fields += [T.StructField(f, T.DoubleType()) for f in features]
    reader = spark.read.schema(T.StructType(fields)).option("header", False)
    return reader.options(**QUOTES).csv(path)


def _declared(spark: SparkSession, table: S.Table, **options: str):
    """A reader of files that have exactly the columns of ``table``."""
    reader = spark.read.schema(S.file_schema(table)).option("header", True)
    return reader.option("enforceSchema", False).options(**QUOTES, **options)


def read_processed(
    spark: SparkSession, path: str | list[str], table: S.Table = S.PROCESSED, **options: str
) -> DataFrame:
    """The processed table, with the columns and order its files are declared to have."""
    return S.to_internal_names(_declared(spark, table, **options).csv(path), table)


RUN_COLUMN = ("run_id", "run_id", "string")


def read_predictions(
    spark: SparkSession, path: str, table: S.Table = S.PREDICTIONS, **options: str
) -> DataFrame:
    """All finished runs in the folder together. ``run_id`` comes from the folder names
    and prunes the scan when filtered on; of a file that lies in the folder itself, or
    in another folder below it, it is the file's name. A file with another header is an
    error, a folder without files gives no rows."""
    found = list_folder(spark, path)
    # Listed before the marks: a run that begins later is not among these folders.
    unfinished = runs.unfinished(spark, path)
    in_runs = [e.path for e in found if e.is_folder and e.name.startswith("run_id=") and e.name[7:] not in unfinished]
    loose = [e.path for e in found if not (e.is_folder and e.name.startswith("run_id="))]
    tables = []
    if in_runs:
        tables.append(_declared(spark, (*table, RUN_COLUMN), basePath=path, **options).csv(in_runs))
    if loose:
        rows = _declared(spark, table, recursiveFileLookup="true", **options).csv(loose)
        tables.append(rows.withColumn("run_id", F.col("_metadata.file_name")))
    if not tables:
        tables = [spark.createDataFrame([], S.file_schema((*table, RUN_COLUMN)))]
    raw = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
    return S.to_internal_names(raw, table)


def read_feature_list(
    spark: SparkSession, path: str, target: str = TARGET_COLUMN
) -> list[str]:
    """Feature names, one per line, in file order; blanks and the target are left out."""
    lines = spark.read.option("wholetext", True).text(path)
    names = lines.select(F.explode(F.split("value", r"\r\n|\r|\n")).alias("v")).select(
        F.trim("v", F.lit(" \t")).alias("name")
    )
    return [r.name for r in names.where("name <> ''").where(F.col("name") != target).collect()]


def pick_input(spark: SparkSession, path: str, which: str = "all") -> list[str]:
    """CSV files below ``path``: all of them (the folder, to be read with ``LISTING``),
    the first by name, or the latest by modification time. Only the listing is read.
    An empty list means no input, also where there is no such path."""
    listing = spark.read.format("binaryFile").options(**LISTING)
    schema = "path string, modificationTime timestamp"
    files = empty_on_missing_path(spark, lambda: listing.load(path).select("path", "modificationTime"), schema)
    if which == "all":
        return [] if files.isEmpty() else [path]
    pick = {
        "first": F.min("path"),
        "latest": F.max_by("path", F.struct("modificationTime", "path")),
    }[which]
    found = files.agg(pick.alias("path")).first().path
    return [found] if found else []
