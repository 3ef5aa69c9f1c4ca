"""Every operator as a query over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitalgrid import config as C
from vitalgrid.functions import bp_diastolic, bp_systolic, fill_number, iso_utc, run_stamp, to_number
from vitalgrid.operators import digest, features, model as trees, scoring
from vitalgrid.operators.ranking import rank_area
from vitalgrid.operators.split import stratified_split as split_by_class
from vitalgrid.operators.vitals import processed_health as processed_with, weekly_vitals as weekly
from vitalgrid.plans import bindings as B, reports
from vitalgrid.session import new_path, staged
from vitalgrid.sources import catalog, readers, schemas as S, writers
from vitalgrid.streaming import score_available, write_reports

TRIAGE_ROWS = 20
MESSAGE_LINES = 25


def weekly_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly(B.vitals(spark, sf_dir))


def processed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.processed(spark, sf_dir)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows written as CSV and read back through the declared schema."""
    processed, path = B.processed(spark, sf_dir), new_path(spark, "processed-csv")
    writers.write_processed(processed, path)
    return readers.read_processed(spark, path, S.table_of(processed))


def bp_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    bp = F.col("bp")
    return B.dirty(spark, sf_dir).select(
        "patient_id",
        bp_systolic(bp).alias("bp_systolic"),
        bp_diastolic(bp).alias("bp_diastolic"),
    )


def numeric_coerce_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = fill_number(to_number(F.col("cholesterol_txt")))
    return B.dirty(spark, sf_dir).select("patient_id", number.alias("cholesterol"))


def category_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.category_counts(B.dirty(spark, sf_dir), "diet")


def one_hot_drop_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = B.dirty(spark, sf_dir)
    encoder = features.fit_encoder(dirty, ("diet", "sex"))
    return _lower(dirty.select("patient_id", *encoder.dummies()))


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _dirty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dirty`` under file column names, with all the identifiers."""
    return B.dirty(spark, sf_dir).select(
        F.col("patient_id").alias(C.ID_COLUMN),
        F.lit("a country").alias("Country"),
        F.lit("a continent").alias("Continent"),
        F.lit("a hemisphere").alias("Hemisphere"),
        F.col("cholesterol_txt").alias("Cholesterol"),
        F.col("bp").alias(C.BLOOD_PRESSURE_COLUMN),
        F.col("sex").alias("Sex"),
        F.col("diet").alias("Diet"),
        F.col("label").alias(C.TARGET_COLUMN),
    )


def one_hot_fixed_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = [f"{c}_{v}" for c, v in C.SERVING_LEVELS]
    table = features.serving_table(_dirty_files(spark, sf_dir), expected, keep=(C.ID_COLUMN,))
    return _lower(table).withColumnRenamed(C.ID_COLUMN.lower(), "patient_id")


def feature_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = ["BMI", "Cholesterol", "Sex_Male"]
    table = features.serving_table(_dirty_files(spark, sf_dir), expected, keep=(C.ID_COLUMN,))
    return _lower(table).withColumnRenamed(C.ID_COLUMN.lower(), "patient_id")


def training_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training preparation: target first, then every feature."""
    rows = _dirty_files(spark, sf_dir)
    encoder = features.fit_encoder(rows, C.CATEGORICAL_COLUMNS)
    table = features.training_table(rows, encoder, keep=(C.ID_COLUMN,))
    return _lower(table).withColumnsRenamed(
        {C.ID_COLUMN.lower(): "patient_id", C.TARGET_COLUMN.lower(): "label"}
    )


def training_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts of the training table written without a header and read back."""
    key, target, path = C.ID_COLUMN, C.TARGET_COLUMN, new_path(spark, "channels")
    rows = _dirty_files(spark, sf_dir)
    encoder = features.fit_encoder(rows, C.CATEGORICAL_COLUMNS)
    table = features.training_table(rows, encoder, keep=(key,))
    order = B.multiplicative_order(F.col(f"`{key}`"))
    parts = staged(split_by_class(table, target, key, order=order).drop(key), "parts")
    names = [c for c in table.columns if c not in (key, target)]
    read = []
    for part in ("train", "test"):
        channel = parts.where(F.col("part") == part).drop("part")
        writers.write_labelled(channel, f"{path}/{part}")
        back = readers.read_labelled(spark, f"{path}/{part}", names)
        read.append(back.withColumn("part", F.lit(part)))
    return _lower(read[0].unionByName(read[1])).withColumnRenamed(target.lower(), "label")


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.dirty(spark, sf_dir).select("patient_id", "label")
    order = B.multiplicative_order(F.col("patient_id"))
    return split_by_class(rows, "label", "patient_id", order=order)


def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.predictions(B.scored(spark, sf_dir))
    return scored.select("patient_id", "risk", "risk_status")


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through an AvailableNow stream over several files in several
    batches."""
    processed, path = B.processed(spark, sf_dir), new_path(spark, "processed")
    processed.repartition(4).write.parquet(path)
    scored = score_available(spark, path, processed.schema, B.linear_scorer, maxFilesPerTrigger=2)
    return scored.select("patient_id", "risk", "risk_status")


def high_risk_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.alerts(B.scored(spark, sf_dir))


def alert_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a few lines each, so that there are several."""
    alerts = scoring.alerts(B.scored(spark, sf_dir))
    lines = digest.alert_lines(alerts)
    return digest.alert_messages(lines, MESSAGE_LINES).select("alerts", "message")


def alerts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts, alert lines and summary written by a run and read back."""
    path = new_path(spark, "reports")
    write_reports(B.scored(spark, sf_dir), path, "r1", C.ALERT_THRESHOLD, replace=False)
    read = lambda name: readers.read_rows(spark, f"{path}/{name}")
    lines = read("alert_lines").select("n", "alerts", F.split("line", ": ")[0].alias("patient_id"), "line")
    summary = read("summary").select(*[F.col(c).cast("bigint").alias(c) for c in ("processed_rows", "scored_rows")])
    found = read("alerts").select("patient_id", F.col("risk_score").cast("double").alias("risk_score"), "status").distinct()
    numbered = lines.withColumns({c: F.col(c).cast("bigint") for c in ("n", "alerts")})
    counted = [F.lit(v).cast("bigint").alias(c) for c, v in summary.first().asDict().items()]
    columns = ["n", "alerts", "line", "risk_score", "status", *counted]
    joined = numbered.join(found, "patient_id")
    return joined.select(F.col("patient_id").cast("bigint").alias("patient_id"), *columns)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.run_summary(B.scored(spark, sf_dir))


def scores_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, top of the triage, averages and summary where scores are NULL or NaN."""
    processed = staged(B.processed(spark, sf_dir), "processed")
    scored = B.with_gaps(B.linear_scorer(processed).select("patient_id", "score"))
    stored = B.with_fixed_stamp(scoring.predictions(scored))
    top = reports.triage_top_risk(stored, processed, 1).select(F.round("predicted_risk", 6).alias("top_risk"))
    tables = (
        digest.run_summary(scored),
        reports.high_risk_count(stored),
        reports.activity_overview(stored, processed).select("avg_predicted_risk"),
        top,
    )
    figures = [  # one row each
        one.select(F.lit(c).alias("figure"), F.col(c).cast("double").alias("value")) for one in tables for c in one.columns
    ]
    return reduce(DataFrame.unionByName, figures)


def skewed_history_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history join where one patient holds a third of the history."""
    one = "CASE WHEN patient_id % 3 = 0 THEN 8 ELSE patient_id END"
    history = B.history(spark, sf_dir).withColumn("patient_id", F.expr(one))
    joined = processed_with(B.vitals(spark, sf_dir), history, rows_per_salt=64)
    return joined.groupBy("patient_id").agg(
        F.count("*").alias("n"),
        F.sum("age").cast("bigint").alias("age_sum"),
        F.countDistinct("diet").alias("diets"),
        F.max("activity_days").alias("activity_days"),
    )


def csv_scan_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings written as text under their file names, some unreadable, read back."""
    path = new_path(spark, "vitals-csv")
    raw = B.vitals(spark, sf_dir).selectExpr(
        "patient_id AS `Patient ID`", "sleep_hours AS `Sleep Hours Per Day`",
        "CASE WHEN patient_id % 11 = 1 THEN 'n/a' ELSE CAST(heart_rate AS STRING) END AS `Heart Rate`",
        "bp_systolic AS BP_Systolic", "bp_diastolic AS BP_Diastolic",
        "physical_activity AS `Physical Activity Per day`", "CAST(1763946244 AS BIGINT) AS Timestamp",
    )
    raw.write.option("header", True).csv(path)
    return readers.read_vitals(spark, path).groupBy("patient_id").agg(
        F.count("*").alias("n"),
        F.count("heart_rate").alias("readings"),
        F.round(F.sum("heart_rate"), 2).alias("heart_rate"),
        F.sum(F.col("bp_systolic") + F.col("bp_diastolic")).alias("pressure"),
        F.count("sleep_hours").alias("nights"),
        F.sum("physical_activity").alias("activity"),
    )


def csv_scan_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with commas, quotes and empty fields among them, written and read back."""
    path = new_path(spark, "history-csv")
    quoted = "CASE patient_id % 3 WHEN 0 THEN CONCAT(diet, ', \"as told\"') WHEN 1 THEN diet ELSE NULL END"
    rows = B.history(spark, sf_dir).select("patient_id", "age", "cholesterol", F.expr(quoted).alias("diet"), "sex", "country")
    writers.write_run(S.to_file_names(rows, S.HISTORY), path, "r1")
    back = readers.read_history(spark, f"{path}/run_id=r1")
    return back.select(F.col("patient_id").cast("bigint").alias("patient_id"), "age", "cholesterol", "diet", "sex", "country")


def feature_list_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of the trained features, in order, through their file; between them lie
    blank lines, the target, and names with space around them."""
    encoder = features.fit_encoder(_dirty_files(spark, sf_dir))
    names = features.training_table(_dirty_files(spark, sf_dir), encoder).columns
    path = new_path(spark, "feature-list")
    lines = [line for i, name in enumerate(names) for line in (("", " \t")[i % 2], (f"  {name}", f"{name}\t ")[i % 2])]
    writers.write_feature_list(spark, lines, path)
    back = readers.read_feature_list(spark, path)
    return spark.createDataFrame(list(enumerate(back, 1)), "position int, name string")


def pick_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the processed files of two runs, the later one is scored."""
    path = new_path(spark, "inputs")
    processed = staged(B.processed(spark, sf_dir), "processed")
    for name, rows in (("b-first", processed.limit(0)), ("a-second", processed)):
        S.to_file_names(rows, S.PROCESSED).coalesce(1).write.option("header", True).csv(f"{path}/{name}")
    picked = readers.pick_input(spark, path, "latest") if not readers.pick_input(spark, f"{path}/none") else []
    rows = readers.read_processed(spark, picked, S.table_of(processed))
    return scoring.predictions(B.linear_scorer(rows)).select("patient_id", "risk", "risk_status")


def serving_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels learned in training, stored, and used for serving: the same features."""
    diets = "CASE patient_id % 4 WHEN 0 THEN 'Keto' WHEN 1 THEN 'average' WHEN 2 THEN 'KETO' ELSE 'Vegan' END"
    rows = _dirty_files(spark, sf_dir).withColumn("Diet", F.expr(diets.replace("patient_id", f"`{C.ID_COLUMN}`")))
    fitted = features.fit_encoder(rows, ("Diet",), ignore_case=True)
    stored = features.Encoder.from_json(fitted.to_json())
    expected = [f"Diet_{v}" for _, v in stored.levels]
    table = features.serving_table(rows, expected, stored, keep=(C.ID_COLUMN,))
    linear = sum(F.col(f"`{name}`") * float(i) for i, name in enumerate(expected, 1))
    return table.select(
        F.col(f"`{C.ID_COLUMN}`").alias("patient_id"), linear.alias("score"), F.lit(len(expected)).alias("dummies")
    )


def utc_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps of the readings' times, every third with a fraction of a second."""
    shift = F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 1_000_000).otherwise(0)
    ts = F.timestamp_micros(F.unix_micros("ts") + shift)
    return B.table(spark, sf_dir, "events").select("event_id", iso_utc(ts).alias("iso"), run_stamp(ts).alias("run"))


def sql_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own SQL on the catalog's tables: quoted names, the ISO function, one run."""
    processed, runs = new_path(spark, "processed"), new_path(spark, "runs")
    rows = staged(B.processed(spark, sf_dir), "processed")
    full = rows.select(*[F.col(n).cast(t) if n in rows.columns else F.lit(None).cast(t).alias(n) for _, n, t in S.PROCESSED])
    writers.write_processed(full, processed)
    database, before = f"sql_reports_{uuid.uuid4().hex[:12]}", spark.catalog.currentDatabase()
    for run in ("r1", "r2"):
        writers.write_predictions(B.predicted(rows), runs, run)
    catalog.create_catalog(spark, processed, runs, database)
    try:
        text = f"""
            SELECT d.`Country`, COUNT(DISTINCT p.`Patient ID`) AS patients,
              MAX(UNIX_SECONDS(from_iso8601_timestamp(p.`ScoredAt`))) AS latest
            FROM {catalog.PREDICTIONS_TABLE} p JOIN {catalog.PROCESSED_TABLE} d ON d.`Patient ID` = p.`Patient ID`
            WHERE p.run_id = 'r2' AND p.`Risk_Status` = '{C.HIGH_RISK}' GROUP BY d.`Country`"""
        # Written, because the tables go with the database.
        return staged(spark.sql(text).withColumnRenamed("Country", "country"), "report")
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE {database} CASCADE")


def row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows only, which is what the cap is for."""
    predicted = B.predicted(B.processed(spark, sf_dir))
    return scoring.row_cap(predicted, ["patient_id"], C.MAX_ROWS_PER_RUN).select("patient_id", "risk")


def fallback_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up ids for rows whose file has no id column."""
    rows = B.predicted(B.processed(spark, sf_dir)).select(
        F.col("patient_id").alias("line"), "risk_status"
    )
    return scoring.with_fallback_id(rows, ["line"], "row_id")


def predictions_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs added to one predictions folder, read together."""
    processed = staged(B.processed(spark, sf_dir), "processed")
    path = new_path(spark, "predictions")
    for run in ("20251124_010404", "20251201_010404"):
        writers.write_predictions(B.predicted(processed), path, run)
    table = (("Patient ID", "patient_id", "bigint"), *S.PREDICTIONS[1:])
    return readers.read_predictions(spark, path, table)


def triage_top_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.triage_top_risk(*B.report_tables(spark, sf_dir), TRIAGE_ROWS)


def high_risk_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.high_risk_count(B.predicted(B.processed(spark, sf_dir)))


def risk_by_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.risk_by_age_band(*B.report_tables(spark, sf_dir))


def risk_by_sleep_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.risk_by_sleep_bucket(*B.report_tables(spark, sf_dir))


def activity_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.activity_overview(*B.report_tables(spark, sf_dir))


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted as planned: without the columns and without writing a table."""
    processed = B.processed(spark, sf_dir)
    count = F.count("*").alias("n")
    return (
        processed.agg(count).withColumn("name", F.lit("processed"))
        .unionByName(B.predicted(processed).agg(count).withColumn("name", F.lit("predictions")))
    )


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows with a target taken from the row itself; 0 without a history."""
    target = F.when(F.col("cholesterol") > 6000, 1).otherwise(0)
    return B.processed(spark, sf_dir).withColumn("heart_attack_risk", target)


def evaluate_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under ROC of the fixed scorer."""
    scored = B.linear_scorer(staged(_labelled(spark, sf_dir), "labelled"))
    # Rounded, so that equal scores are equal whatever computed the exponential.
    rounded = scoring.predictions(scored).select("risk", "heart_attack_risk")
    auc = trees.evaluation(rounded, "heart_attack_risk", "risk")
    return auc.select(F.round("auc", 6).alias("auc"))


def _trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train with the configured rounds on one part of the labelled rows. Both parts
    scored by the model, and the raw rows scored by the saved one as in serving."""
    # Written once: levels, split and training all read it.
    rows = S.to_file_names(staged(_labelled(spark, sf_dir), "labelled"), S.HISTORY)
    encoder = features.fit_encoder(rows, C.CATEGORICAL_COLUMNS)
    key, target, path = C.ID_COLUMN, C.TARGET_COLUMN, new_path(spark, "model")
    prepared = features.training_table(rows, encoder, keep=(key,))
    names = [c for c in prepared.columns if c not in (key, target)]
    order = B.multiplicative_order(F.col(f"`{key}`"))
    parts = staged(split_by_class(prepared, target, key, order=order), "parts")
    fitted = trees.train(parts.where("part = 'train'"), names, target, C.TreeParams())
    trees.save(fitted, path, encoder)
    scorer = trees.serving_scorer(trees.load(path), names, trees.load_encoder(spark, path))
    return staged(trees.score(fitted, parts), "scores"), scorer(rows)


def gbt_batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of a trained model's scores whatever its trees: each row has a risk
    and the status that goes with it, and the saved model gives the same."""
    scored, served = _trained(spark, sf_dir)
    key = F.col(f"`{C.ID_COLUMN}`").alias("patient_id")
    rows = scoring.predictions(scored).select(key, "part", "risk", "risk_status", "score")
    again = served.groupBy("patient_id").agg(F.min("score").alias("low"), F.max("score").alias("high"))
    return rows.join(again, "patient_id").select(
        "patient_id",
        "part",
        F.col("risk").between(0, 1).alias("in_range"),
        (F.col("risk_status") == F.when(F.col("score") > C.ALERT_THRESHOLD, C.HIGH_RISK).otherwise(C.LOW_RISK)).alias("status_agrees"),
        ((F.col("low") == F.col("score")) & (F.col("high") == F.col("score"))).alias("saved_agrees"),
    )


def gbt_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluator's area of the test part against that from ranks."""
    scored, _ = _trained(spark, sf_dir)
    test = scored.where("part = 'test'").select(F.col(f"`{C.TARGET_COLUMN}`"), "score")
    auc = trees.area_under_roc(test)
    by_rank = rank_area(test, C.TARGET_COLUMN)
    same = F.col("auc").eqNullSafe(F.lit(auc).cast("double")) | (F.abs(F.col("auc") - F.lit(auc)) < 1e-9)
    return by_rank.select("rows", "positives", same.alias("areas_agree"), F.coalesce(F.col("auc").between(0, 1), F.lit(True)).alias("in_range"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        weekly_vitals,
        processed_health,
        csv_round_trip,
        bp_split,
        numeric_coerce_fill,
        category_vocabulary,
        one_hot_drop_first,
        one_hot_fixed_vocabulary,
        feature_align,
        training_features,
        stratified_split,
        training_channels,
        batch_score,
        stream_score,
        high_risk_alerts,
        alert_digest,
        alerts_table,
        run_summary,
        scores_with_gaps,
        skewed_history_join,
        csv_scan_vitals,
        csv_scan_history,
        feature_list_round_trip,
        pick_latest_run,
        serving_parity,
        sql_reports,
        utc_stamps,
        row_cap,
        fallback_id,
        predictions_union,
        triage_top_risk,
        high_risk_count,
        risk_by_age_band,
        risk_by_sleep_bucket,
        activity_overview,
        table_row_counts,
        evaluate_auc,
        gbt_batch_score,
        gbt_evaluate,
    )
}
