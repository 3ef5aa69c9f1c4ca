"""The jobs of the pipeline, from files to files."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from vitalgrid import config as C, streaming
from vitalgrid.operators import boosting, digest, features, model as trees, scoring, weeks
from vitalgrid.operators.split import group_split, stratified_split
from vitalgrid.operators.vitals import processed_health
from vitalgrid.plans import reports
from vitalgrid.session import exists, staged
from vitalgrid.sources import ledger, readers, runs, schemas, writers


@dataclass(frozen=True)
class Preview:
    """What a job shows of its result: columns, number of rows, and the first of them."""

    columns: list[str]
    rows: int
    head: list[Row]


def preview(df: DataFrame, rows: int = 5) -> Preview:
    return Preview(df.columns, df.count(), df.take(rows))


def aggregate_job(
    spark: SparkSession, vitals: str, history: str, out: str, single_file: bool = False
) -> Preview:
    """Weekly profiles joined to the history, as CSV."""
    processed = processed_health(
        readers.read_vitals(spark, vitals), readers.read_history(spark, history)
    )
    writers.write_processed(processed, out, single_file)
    return preview(readers.read_processed(spark, out, schemas.table_of(processed)))


#: Classifiers: those of Spark ML, and those with second-order leaf weights.
METHODS = ("trees", "boosted")


@dataclass(frozen=True)
class Training:
    model: PipelineModel | boosting.Boosted
    features: list[str]
    auc: float | None


def training_job(
    table: DataFrame,
    out: str,
    settings: C.Settings = C.Settings(),
    target: str = C.TARGET_COLUMN,
    key: str = C.ID_COLUMN,
    drop_unlabelled: bool = False,
    method: str = METHODS[0],
    by_patient: bool = False,
) -> Training:
    """Prepare, split, write both parts and the feature list, fit, evaluate, save.
    ``method`` is one of ``METHODS``; ``by_patient`` keeps all rows of an id in one part.

    ``table`` is any table with the target and an id, under file column names. A
    missing target counts as 0 unless such rows are dropped.
    """
    spark = table.sparkSession
    if target not in table.columns:
        raise ValueError(f"the training table has no column {target!r}")
    if drop_unlabelled:
        table = table.where(F.col(f"`{target}`").isNotNull())
    categorical = tuple(c for c in C.CATEGORICAL_COLUMNS if c in table.columns)
    encoder = features.fit_encoder(table, categorical, settings.max_levels)
    prepared = features.training_table(table, encoder, target, keep=(key,))
    names = [c for c in prepared.columns if c not in (key, target)]
    split = group_split if by_patient else stratified_split
    parts = split(prepared, target, key, settings.test_share, name="_part", seed=settings.seed)
    # Written once: both files and every round of training read it.
    parts = staged(parts.drop(key), "parts")
    train = parts.where("_part = 'train'").drop("_part")
    test = parts.where("_part = 'test'").drop("_part")
    out = out.rstrip("/")
    writers.write_labelled(train, f"{out}/train")
    writers.write_labelled(test, f"{out}/test")
    writers.write_feature_list(spark, names, f"{out}/feature_list")
    tree = replace(settings.tree, seed=settings.seed)
    if method == "boosted":
        fitted = boosting.train(train, names, target, boosted_params(tree))
        boosting.save(spark, fitted, f"{out}/model", encoder)
        scored = fitted.score(test)
    else:
        fitted = trees.train(train, names, target, tree)
        trees.save(fitted, f"{out}/model", encoder)
        scored = trees.score(fitted, test)
    return Training(fitted, names, trees.area_under_roc(scored, target))


def boosted_params(tree: C.TreeParams) -> boosting.BoostParams:
    """The same settings for the other classifier."""
    return boosting.BoostParams(tree.max_iter, tree.step_size, tree.max_depth, tree.subsampling_rate, float(tree.feature_subset), tree.seed)


def saved_scorer(spark: SparkSession, model: str, feature_list: str) -> scoring.Scorer:
    """The scorer of a saved model of either method."""
    expected = readers.read_feature_list(spark, feature_list)
    if exists(spark, f"{model.rstrip('/')}/boosted.json"):
        fitted, encoder = boosting.load(spark, model)
        return boosting.serving_scorer(fitted, expected, encoder)
    return trees.serving_scorer(trees.load(model), expected, trees.load_encoder(spark, model))


def weekly_job(spark: SparkSession, vitals: str, out: str, zone: str = "UTC", slide: int = weeks.WEEK) -> Preview:
    """Profiles by calendar week, as parquet. The files' time is in seconds of the epoch."""
    readings = readers.read_vitals(spark, vitals).withColumn("ts", F.timestamp_seconds("timestamp"))
    weeks.weekly_vitals_by_week(readings, zone, slide).write.mode("overwrite").parquet(out)
    return preview(spark.read.parquet(out))


@dataclass(frozen=True)
class ScoringRun:
    """Tables of one run; only the summary is there when no input was found."""

    summary: DataFrame
    scored: DataFrame | None = None
    predictions: DataFrame | None = None
    alerts: DataFrame | None = None
    lines: DataFrame | None = None
    run_id: str | None = None


def report_folders(report_to: str, run_id: str) -> list[str]:
    return [f"{report_to.rstrip('/')}/{name}/run_id={run_id}" for name in streaming.REPORTS]


def write_scores(
    run: runs.Run, scored: DataFrame, threshold: float, report_to: str | None, replace: bool
) -> None:
    """All that a run writes: predictions, and the reports if asked for."""
    stored = scoring.predictions(scored, threshold)
    writers.write_prediction_rows(stored, run.base, run.run_id, replace)
    if report_to:
        streaming.write_reports(scored, report_to.rstrip("/"), run.run_id, threshold, replace)
    run.rows = {c: v for c, v in digest.run_summary(scored, threshold).first().asDict().items() if isinstance(v, int)}


def scoring_job(
    spark: SparkSession,
    processed: str,
    feature_list: str,
    model: str,
    predictions: str,
    settings: C.Settings = C.Settings(),
    which: str = "all",
    order: list[str] | None = None,
    run_id: str | None = None,
    report_to: str | None = None,
) -> ScoringRun:
    """Score processed CSV files and add the run to the predictions folder.

    ``order`` gives the row order for a row cap or for made-up ids; without a cap and
    with ids in the file it is not needed. A named run replaces itself; otherwise every
    run has a name of its own. Alerts, alert lines and summary are written below
    ``report_to``. Readers see all of them or nothing: a run that fails in between is
    left out until ``sources.recover`` deletes it.
    """
    files = readers.pick_input(spark, processed, which)
    if not files:
        summary = digest.no_input_summary(spark)
        if report_to:
            writers.write_run(summary, f"{report_to.rstrip('/')}/no_input", run_id or writers.new_run_id(spark), run_id is not None)
        return ScoringRun(summary)
    rows = readers.read_rows(spark, files, **readers.LISTING)
    order = order or ([C.ID_COLUMN] if C.ID_COLUMN in rows.columns else rows.columns)
    rows = scoring.with_fallback_id(rows, order)
    scorer = saved_scorer(spark, model, feature_list)
    scored = scorer(scoring.row_cap(rows, order, settings.max_rows))
    # Written once: predictions, alerts, lines and summary all read it.
    scored = staged(writers.with_scored_at(scored), "scored")
    named, run_id = run_id is not None, run_id or writers.new_run_id(spark)
    folders = [writers.prediction_folder(predictions, run_id), *(report_folders(report_to, run_id) if report_to else [])]
    with runs.run(spark, predictions, run_id, folders, replace=named) as run:
        write_scores(run, scored, settings.alert_threshold, report_to, named)
    alerts = scoring.alerts(scored, settings.alert_threshold)
    summary = digest.run_summary(scored, settings.alert_threshold)
    if settings.max_rows is not None:
        summary = summary.withColumn("processed_rows", F.lit(rows.count()).cast("bigint"))
    return ScoringRun(
        summary=summary,
        scored=scored,
        predictions=scoring.predictions(scored, settings.alert_threshold),
        alerts=alerts,
        lines=digest.alert_lines(alerts),
        run_id=run_id,
    )


def score_new_files(
    spark: SparkSession,
    inputs: str,
    predictions: str,
    scorer: scoring.Scorer,
    table: schemas.Table | None = schemas.PROCESSED,
    threshold: float = C.ALERT_THRESHOLD,
    run_id: str | None = None,
    report_to: str | None = None,
) -> DataFrame:
    """Score the CSV files below ``inputs`` that no finished run has scored as they are
    now, as one run, and note them in the ledger. ``scorer`` takes rows under internal
    names, or without a ``table`` raw rows under file names, as that of a saved model.
    The summary; that of no input if nothing is new."""
    fresh = ledger.new_files(spark, inputs, predictions)
    run_id = run_id or writers.new_run_id(spark)
    folders = [writers.prediction_folder(predictions, run_id), ledger.folder_of(predictions, run_id)]
    if fresh.isEmpty():
        return digest.no_input_summary(spark)
    with runs.run(spark, predictions, run_id, folders + (report_folders(report_to, run_id) if report_to else [])) as run:
        mine = ledger.claim(run, fresh)
        if mine:
            paths = [f.path for f in mine]
            rows = readers.read_processed(spark, paths, table) if table else readers.read_rows(spark, paths)
            scored = staged(writers.with_scored_at(scorer(rows)), "scored")
            write_scores(run, scored, threshold, report_to, replace=False)
            ledger.record(run, mine)
    return digest.run_summary(scored, threshold) if mine else digest.no_input_summary(spark)


def streaming_job(
    spark: SparkSession,
    processed: str,
    feature_list: str,
    model: str,
    sink: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    schema: T.StructType | None = None,
    **options: object,
) -> StreamingQuery:
    """Score processed CSV files as they arrive. The columns are those named, else those
    of the header of the files already there, else those of the processed table."""
    if schema is None and readers.pick_input(spark, processed):
        schema = readers.read_rows(spark, processed, **readers.LISTING).schema
    if schema is None:
        schema = T.StructType([T.StructField(f, T.StringType()) for f, _, _ in schemas.PROCESSED])
    options = {"header": True, "enforceSchema": False, **readers.QUOTES, **readers.LISTING, **options}
    source = streaming.file_stream(spark, processed, schema, "csv", **options)
    scorer = saved_scorer(spark, model, feature_list)
    return streaming.score_stream(source, scorer, sink, checkpoint, available_now=available_now)


def report_job(
    predictions: DataFrame, processed: DataFrame, settings: C.Settings = C.Settings()
) -> dict[str, DataFrame]:
    """The five analytics reports by name."""
    return {
        "triage_top_risk": reports.triage_top_risk(predictions, processed, settings.triage_size),
        "high_risk_count": reports.high_risk_count(predictions, settings.alert_threshold),
        "risk_by_age_band": reports.risk_by_age_band(predictions, processed),
        "risk_by_sleep_bucket": reports.risk_by_sleep_bucket(predictions, processed),
        "activity_overview": reports.activity_overview(predictions, processed),
    }
