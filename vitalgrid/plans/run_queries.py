"""Queries over files, runs and streams, and their SQL twins.

The SQL uses the tables that the entry file defines in front of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitalgrid.functions import parse_iso
from vitalgrid.operators import scoring
from vitalgrid.plans import bindings as B, pipeline
from vitalgrid.session import delete, list_folder, move, new_path, staged
from vitalgrid.sources import catalog, readers, runs, schemas as S, writers
from vitalgrid.streaming import score_available

#: Predictions under internal names, with the id as a number as in the test tables.
STORED = (("Patient ID", "patient_id", "bigint"), *S.PREDICTIONS[1:])


def write_file(rows: DataFrame, path: str) -> None:
    """One CSV file of that very name."""
    spark, folder = rows.sparkSession, f"{path}.parts"
    rows.coalesce(1).write.option("header", True).options(**writers.WRITTEN).csv(folder)
    (part,) = [e.path for e in list_folder(spark, folder) if e.name.endswith(".csv")]
    delete(spark, path)
    move(spark, part, path)
    delete(spark, folder)


def predictions_mixed_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, and a file that lies in the folder itself, by the reader and by SQL."""
    path, processed = new_path(spark, "predictions"), staged(B.processed(spark, sf_dir), "processed")
    stored = staged(B.predicted(processed), "stored")
    writers.write_predictions(stored.where("patient_id % 2 = 0"), path, "r1")
    loose = stored.where("patient_id % 2 = 1").select([n for _, n, _ in S.PREDICTIONS])
    write_file(S.to_file_names(loose, S.PREDICTIONS), f"{path}/loose.csv")
    by_reader = readers.read_predictions(spark, path, STORED).select("patient_id", "risk", "run_id", F.lit("reader").alias("via"))
    database, before = f"mixed_{uuid.uuid4().hex[:12]}", spark.catalog.currentDatabase()
    catalog.create_catalog(spark, new_path(spark, "none"), path, database)
    try:
        by_sql = spark.sql(f"SELECT CAST(`Patient ID` AS BIGINT) AS patient_id, `Heart Attack Risk` AS risk, run_id, 'sql' AS via FROM {catalog.PREDICTIONS_TABLE}")
        by_sql = staged(by_sql, "by-sql")  # the tables go with the database
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return by_reader.unionByName(by_sql)


def csv_line_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of several lines, with quotes and commas, written and read back."""
    path = new_path(spark, "history-csv")
    lines = "CASE patient_id % 3 WHEN 0 THEN CONCAT(diet, ',\\n\"as told\"\\n') WHEN 1 THEN CONCAT('\\r\\n', diet) ELSE diet END"
    rows = B.history(spark, sf_dir).select("patient_id", "age", F.expr(lines).alias("diet"), "country")
    writers.write_run(S.to_file_names(rows, S.HISTORY), path, "r1", line_feeds=True)
    back = readers.read_history(spark, f"{path}/run_id=r1", **readers.LINE_FEEDS)
    return back.select(F.col("patient_id").cast("bigint").alias("patient_id"), "age", "diet", "country")


def training_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows read back under their file names: numbers by type, odd ones NULL."""
    path = new_path(spark, "training-csv")
    rows = B.dirty(spark, sf_dir).select(
        F.col("patient_id").cast("string").alias("Patient ID"), F.col("bp").alias("Blood Pressure"),
        F.col("cholesterol_txt").alias("Cholesterol"), F.col("sex").alias("Sex"), F.col("label").alias("Heart Attack Risk"),
        F.lit("x").alias("Notes"),
    )
    writers.write_run(rows, path, "r1")
    back = readers.read_training(spark, f"{path}/run_id=r1")
    return back.select(
        F.col("`Patient ID`").cast("bigint").alias("patient_id"), F.col("`Blood Pressure`").alias("bp"),
        F.col("Cholesterol").alias("cholesterol"), F.col("Sex").alias("sex"), F.col("`Heart Attack Risk`").alias("label"), F.col("Notes").alias("notes"),
    )


def stream_no_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over a folder that is not there, then empty, then filled: rows scored."""
    path, sink = new_path(spark, "arriving"), new_path(spark, "scored")
    processed = staged(B.processed(spark, sf_dir), "processed")

    def scored(step: str) -> DataFrame:
        rows = score_available(spark, path, processed.schema, B.linear_scorer, sink)
        return rows.agg(F.count("*").alias("n"), F.count_distinct("patient_id").alias("patients")).withColumn("step", F.lit(step))

    steps = [staged(scored("missing"), "step")]
    processed.limit(0).write.parquet(path)
    steps.append(staged(scored("empty"), "step"))
    processed.write.mode("append").parquet(path)
    steps += [staged(scored("filled"), "step"), staged(scored("again"), "step")]
    return steps[0].unionByName(steps[1]).unionByName(steps[2]).unionByName(steps[3])


def preview_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the aggregation job shows of its result: columns, rows, and the first rows,
    each of which is one of the table."""
    vitals, history, out = (new_path(spark, n) for n in ("vitals", "history", "processed"))
    writers.write_run(S.to_file_names(B.vitals(spark, sf_dir).withColumn("timestamp", F.lit(0)), S.VITALS), vitals, "r")
    writers.write_run(S.to_file_names(B.history(spark, sf_dir), S.HISTORY), history, "r")
    shown = pipeline.aggregate_job(spark, f"{vitals}/run_id=r", f"{history}/run_id=r", out)
    ids = sorted({int(r.patient_id) for r in shown.head})
    known = B.processed(spark, sf_dir).where(F.col("patient_id").isin(ids)).agg(F.count_distinct("patient_id").alias("k"))
    return known.select(
        F.lit(len(shown.columns)).alias("columns"), F.lit(shown.rows).cast("bigint").alias("rows"),
        (F.col("k") == len(ids)).alias("head_known"), F.lit(len(shown.head)).alias("head"),
    )


def scored_at_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamp of a run's rows, as stored and read back: ISO text, not in the future,
    and the same in all rows of the run."""
    path = new_path(spark, "predictions")
    rows = writers.with_scored_at(scoring.predictions(B.scored(spark, sf_dir)))
    writers.write_predictions(rows, path, "r1")
    back = staged(readers.read_predictions(spark, path, STORED), "back")
    least = F.lit(back.agg(F.min("scored_at")).first()[0])
    text = F.col("scored_at")
    return back.select(
        "patient_id",
        text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{6})?Z$").alias("is_iso"),
        (parse_iso(text) <= F.current_timestamp()).alias("is_past"),
        (text == least).alias("is_shared"),
    )


class Interrupted(Exception):
    pass


def committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, of which one breaks off between its sinks and one replaces itself: what
    readers see, and what manifests tell."""
    path, reports = new_path(spark, "predictions"), new_path(spark, "reports")
    scored = staged(writers.with_scored_at(B.scored(spark, sf_dir)), "scored")

    def write(run_id: str, rows: DataFrame, breaks: bool = False, replace: bool = False) -> None:
        folders = [writers.prediction_folder(path, run_id), *pipeline.report_folders(reports, run_id)]
        with runs.run(spark, path, run_id, folders, replace) as run:
            pipeline.write_scores(run, rows, 0.45, None if breaks else reports, replace)
            if breaks:
                raise Interrupted

    write("r1", scored.where("patient_id % 2 = 0"))
    try:
        write("r2", scored, breaks=True)
    except Interrupted:
        pass
    write("r3", scored.where("patient_id % 3 = 0"))
    write("r3", scored.where("patient_id % 3 = 1"), replace=True)
    counts = runs.manifests(spark, path).select("run_id", F.col("rows")["scored_rows"].alias("run_rows"))
    return readers.read_predictions(spark, path, STORED).select("patient_id", "risk", "run_id").join(counts, "run_id")


def score_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three triggers over a folder: two files, then another, then one of the first two
    replaced, then nothing. Every file is scored once, the replaced one again."""
    inputs, path = new_path(spark, "inputs"), new_path(spark, "predictions")
    processed = staged(B.processed(spark, sf_dir), "processed")
    table = S.table_of(processed)

    def put(name: str, rest: int) -> None:
        write_file(S.to_file_names(processed.where(f"patient_id % 4 = {rest}"), S.PROCESSED), f"{inputs}/{name}.csv")

    for run_id, files in (("t1", {"a": 0, "b": 1}), ("t2", {"c": 2}), ("t3", {"b": 3}), ("t4", {})):
        for name, rest in files.items():
            put(name, rest)
        pipeline.score_new_files(spark, inputs, path, B.linear_scorer, table, run_id=run_id)
    return readers.read_predictions(spark, path, STORED).select("patient_id", "risk", "risk_status", "run_id")


QUERIES = {
    q.__name__: q
    for q in (
        predictions_mixed_folder,
        csv_line_feeds,
        training_scan,
        stream_no_input,
        preview_shape,
        scored_at_stamps,
        committed_runs,
        score_new_files,
    )
}

SQL = {
    "predictions_mixed_folder": """
SELECT patient_id, risk, CASE WHEN patient_id % 2 = 0 THEN 'r1' ELSE 'loose.csv' END AS run_id, via
FROM pred, (VALUES ('reader'), ('sql')) v(via)
""",
    "csv_line_feeds": """
SELECT patient_id, age, CASE patient_id % 3 WHEN 0 THEN diet || ',' || CHR(10) || '"as told"' || CHR(10)
    WHEN 1 THEN CHR(13) || CHR(10) || diet ELSE diet END AS diet, country
FROM demo
""",
    "training_scan": """
SELECT patient_id, bp, TRY_CAST(cholesterol_txt AS DOUBLE) AS cholesterol, sex, CAST(label AS INT) AS label, 'x' AS notes FROM dirty
""",
    "stream_no_input": """
SELECT step, CASE WHEN step IN ('filled', 'again') THEN n ELSE 0 END AS n, CASE WHEN step IN ('filled', 'again') THEN patients ELSE 0 END AS patients
FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT patient_id) AS patients FROM processed) c, (VALUES ('missing'), ('empty'), ('filled'), ('again')) s(step)
""",
    "preview_shape": """
SELECT CAST(11 AS INT) AS columns, COUNT(*) AS rows, TRUE AS head_known, CAST(LEAST(COUNT(*), 5) AS INT) AS head FROM processed
""",
    "scored_at_stamps": """
SELECT patient_id, TRUE AS is_iso, TRUE AS is_past, TRUE AS is_shared FROM pred
""",
    "committed_runs": """
SELECT patient_id, risk, run_id, COUNT(*) OVER (PARTITION BY run_id) AS run_rows
FROM (SELECT patient_id, risk, 'r1' AS run_id FROM pred WHERE patient_id % 2 = 0
      UNION ALL SELECT patient_id, risk, 'r3' FROM pred WHERE patient_id % 3 = 1) t
""",
    "score_new_files": """
SELECT patient_id, risk, risk_status, CASE patient_id % 4 WHEN 2 THEN 't2' WHEN 3 THEN 't3' ELSE 't1' END AS run_id FROM pred
""",
}
