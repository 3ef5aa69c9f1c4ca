"""Jobs from files to files, training, and streaming against batch."""

import random

import pytest

from vitalgrid import config as C
from vitalgrid.operators import features, model as trees
from vitalgrid.plans import bindings as B, pipeline, reports
from vitalgrid.sources import read_labelled, read_predictions, read_processed, read_training, schemas as S
from vitalgrid.streaming import read_all_rows, read_scored, score_available, score_stream
from vitalgrid.streaming.scoring import file_stream

SETTINGS = C.Settings(tree=C.TreeParams(max_iter=3, max_depth=3))
PATIENTS = 200


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Vitals and history files, the target following age and sex."""
    root, rng = tmp_path_factory.mktemp("files"), random.Random(7)
    vitals = [",".join(f for f, _, _ in S.VITALS)]
    history = [",".join(f for f, _, _ in S.HISTORY)]
    for i in range(PATIENTS):
        pid, age, male = f"P{i:04d}", rng.randint(18, 90), rng.random() < 0.5
        for d in range(7):
            vitals.append(f"{pid},{rng.randint(60, 110)},{rng.randint(100, 170)},"
                          f"{rng.randint(60, 120)},{rng.uniform(3, 9):.1f},{rng.randint(0, 1)},{d}")
        if i % 10 == 3:
            continue
        row = {f: str(rng.randint(0, 1)) for f, _, _ in S.HISTORY} | {
            "Patient ID": pid, "Age": str(age), "Sex": "Male" if male else "Female",
            "Diet": rng.choice(["Healthy", "Average", "Unhealthy"]), "Blood Pressure": "130/85",
            "Country": "X", "Continent": "Y", "Hemisphere": "N",
            "Heart Attack Risk": str(int(age + 20 * male + rng.gauss(0, 5) > 65)),
        }
        history.append(",".join(row[f] for f, _, _ in S.HISTORY))
    (root / "vitals.csv").write_text("\n".join(vitals) + "\n")
    (root / "history.csv").write_text("\n".join(history) + "\n")
    return root


@pytest.fixture(scope="module")
def aggregated(spark, files):
    shown = pipeline.aggregate_job(
        spark, str(files / "vitals.csv"), str(files / "history.csv"), str(files / "processed")
    )
    assert shown.columns == [n for _, n, _ in S.PROCESSED]
    assert shown.rows == PATIENTS and len(shown.head) == 5
    return str(files / "processed")


@pytest.fixture(scope="module")
def trained(spark, files):
    table = read_training(spark, str(files / "history.csv"))
    return pipeline.training_job(table, str(files / "out"), SETTINGS)


def test_aggregate_job(spark, aggregated):
    df = read_processed(spark, aggregated)
    assert df.count() == PATIENTS
    assert df.where("age IS NULL").count() == PATIENTS // 10
    assert df.where("activity_days NOT BETWEEN 0 AND 7 OR blood_pressure NOT LIKE '%/%'").count() == 0


def test_training_job(spark, files, trained):
    assert len(trained.features) == 23 and trained.features[-3:] == [
        "Sex_Male", "Diet_Healthy", "Diet_Unhealthy",
    ]
    assert trained.auc > 0.8
    train = spark.read.csv(str(files / "out" / "train"))
    test = spark.read.csv(str(files / "out" / "test"))
    assert train.count() + test.count() == PATIENTS * 9 // 10
    assert len(train.columns) == 24
    assert {r[0] for r in train.select("_c0").distinct().collect()} == {"0", "1"}


def test_training_repeats_and_reloads(spark, files, trained):
    table = read_training(spark, str(files / "history.csv"))
    again = pipeline.training_job(table, str(files / "again"), SETTINGS)
    assert again.auc == trained.auc
    encoder = trees.load_encoder(spark, str(files / "out" / "model"))
    rows = features.serving_table(table, trained.features, encoder, keep=("Patient ID",))
    scores = lambda m: [tuple(r) for r in trees.score(m, rows).select("Patient ID", "score").orderBy("Patient ID").collect()]
    loaded = trees.load(str(files / "out" / "model"))
    assert scores(loaded) == scores(trained.model)
    assert trees.feature_names(loaded) == trained.features
    assert all(0 < s < 1 for _, s in scores(loaded))


def test_training_needs_the_target(spark, aggregated):
    with pytest.raises(ValueError, match="Heart Attack Risk"):
        pipeline.training_job(read_training(spark, aggregated), "unused", SETTINGS)


def score(spark, files, aggregated, name, **settings):
    return pipeline.scoring_job(
        spark, aggregated, str(files / "out" / "feature_list"), str(files / "out" / "model"),
        str(files / name), C.Settings(**settings), run_id="r1",
    )


def test_scoring_job_and_reports(spark, files, aggregated, trained):
    run = score(spark, files, aggregated, "predictions")
    summary = run.summary.first()
    assert (summary.processed_rows, summary.scored_rows) == (PATIENTS, PATIENTS)
    assert 0 < summary.alerts_triggered < PATIENTS
    assert run.alerts.count() == summary.alerts_triggered == run.lines.count()
    stored = read_predictions(spark, str(files / "predictions"))
    assert stored.count() == PATIENTS
    processed = read_processed(spark, aggregated)
    tables = pipeline.report_job(stored, processed)
    assert tables["triage_top_risk"].count() == PATIENTS
    assert sum(r.patients for r in tables["risk_by_age_band"].collect()) == PATIENTS
    assert sum(r.patients for r in tables["risk_by_sleep_bucket"].collect()) == PATIENTS
    assert tables["activity_overview"].count() == 1
    assert reports.high_risk_count(stored).first()[0] <= summary.alerts_triggered


def test_streaming_job_equals_scoring_job(spark, files, aggregated, trained, tmp_path):
    batch = score(spark, files, aggregated, "again-predictions")
    pipeline.streaming_job(
        spark, aggregated, str(files / "out" / "feature_list"), str(files / "out" / "model"),
        str(tmp_path / "sink"), str(tmp_path / "checkpoint"),
    ).awaitTermination()
    columns = ("patient_id", "risk", "risk_status")
    stream = read_scored(spark, str(tmp_path / "sink"))
    rows = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert rows(stream) == rows(batch.predictions) and stream.count() == PATIENTS


def test_training_from_written_channels(spark, files, trained):
    train = read_labelled(spark, str(files / "out" / "train"), trained.features)
    test = read_labelled(spark, str(files / "out" / "test"), trained.features)
    fitted = trees.train(train, trained.features, params=SETTINGS.tree)
    assert trees.area_under_roc(trees.score(fitted, test)) > 0.8
    assert train.where("`Heart Attack Risk` IS NULL").count() == 0


def test_capped_scoring_reports_all_rows(spark, files, aggregated, trained):
    run = score(spark, files, aggregated, "capped", max_rows=C.MAX_ROWS_PER_RUN)
    summary = run.summary.first()
    assert (summary.processed_rows, summary.scored_rows) == (PATIENTS, 50)
    first = sorted(r.patient_id for r in run.scored.collect())
    assert first[0] == "P0000" and first[-1] == "P0049"


def test_scoring_without_input(spark, files, trained, tmp_path):
    for path in (tmp_path, tmp_path / "missing"):
        run = score(spark, files, str(path), "none")
        assert tuple(run.summary.first()) == (404, "No CSV file found.")
        assert run.predictions is None


def test_seed_changes_the_split(spark, files, trained, tmp_path):
    table = read_training(spark, str(files / "history.csv"))
    few = C.TreeParams(max_iter=1, max_depth=2)
    parts = lambda seed, name: (
        pipeline.training_job(table, str(tmp_path / name), C.Settings(tree=few, seed=seed)),
        sorted(map(tuple, spark.read.csv(str(tmp_path / name / "test")).collect())),
    )[1]
    assert parts(1, "a") == parts(1, "b") != parts(2, "c")


def test_two_runs_at_once_and_their_reports(spark, files, aggregated, trained, tmp_path):
    out, reports_to = str(tmp_path / "pred"), str(tmp_path / "rep")
    runs = [
        pipeline.scoring_job(
            spark, aggregated, str(files / "out" / "feature_list"), str(files / "out" / "model"), out, report_to=reports_to
        )
        for _ in range(2)
    ]
    assert runs[0].run_id != runs[1].run_id
    assert read_predictions(spark, out).count() == 2 * PATIENTS
    for name in ("alerts", "alert_lines"):
        assert spark.read.option("header", True).csv(f"{reports_to}/{name}").count() == 2 * runs[0].alerts.count()
    assert spark.read.option("header", True).csv(f"{reports_to}/summary").count() == 2


def test_two_triggers_with_default_settings_add_up(spark, tmp_path):
    path, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([(i, 0.1 * i if i else None) for i in range(5)], "patient_id int, score double")
    rows.write.parquet(path)
    trigger = lambda **named: score_stream(file_stream(spark, path, rows.schema), lambda b: b, sink, **named).awaitTermination()
    trigger()
    rows.withColumn("patient_id", rows.patient_id + 10).write.mode("append").parquet(path)
    trigger()
    every = read_all_rows(spark, sink)
    assert every.count() == 10 and read_scored(spark, sink).count() == 8
    # Another checkpoint is another query: it repeats rows and deletes none.
    trigger(checkpoint=str(tmp_path / "other"))
    assert read_all_rows(spark, sink).count() == 20
    summaries = spark.read.option("header", True).csv(f"{sink}/summary").collect()
    assert sum(int(r.processed_rows) for r in summaries) == 20
    assert sum(int(r.scored_rows) for r in summaries) == 16


def test_stream_over_an_empty_folder(spark, files, trained, tmp_path):
    (tmp_path / "in").mkdir()
    pipeline.streaming_job(
        spark, str(tmp_path / "in"), str(files / "out" / "feature_list"), str(files / "out" / "model"), str(tmp_path / "sink")
    ).awaitTermination()


def test_stream_in_several_batches_equals_batch(spark, tmp_path):
    processed = B.processed(spark, "/root/testdata/sf0.01")
    path, sink = str(tmp_path / "in"), str(tmp_path / "out")
    processed.repartition(5).write.parquet(path)
    got = score_available(
        spark, path, processed.schema, B.linear_scorer, sink, str(tmp_path / "c"), maxFilesPerTrigger=2
    )
    assert got.select("run_id").distinct().count() == 3
    want = B.predicted(processed).select("patient_id", "risk", "risk_status")
    columns = ("patient_id", "risk", "risk_status")
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.collect()))

    # A second trigger scores only what is new.
    processed.limit(3).coalesce(1).write.mode("append").parquet(path)
    source = file_stream(spark, path, processed.schema)
    score_stream(source, B.linear_scorer, sink, str(tmp_path / "c")).awaitTermination()
    after = read_scored(spark, sink)
    assert after.count() == processed.count() + 3


def test_boosted_training_scores_batches_and_new_files(spark, files, aggregated, trained, tmp_path):
    table = read_training(spark, str(files / "history.csv"))
    out = str(tmp_path / "boosted")
    done = pipeline.training_job(table, out, SETTINGS, method="boosted", by_patient=True)
    assert done.features == trained.features and done.auc > 0.8 and len(done.model.trees) == 3
    scorer = pipeline.saved_scorer(spark, f"{out}/model", f"{out}/feature_list")
    predictions = str(tmp_path / "predictions")
    for names in ([], ["b.csv"]):
        new = pipeline.score_new_files(spark, aggregated, predictions, scorer, None, report_to=str(tmp_path / "reports"))
        assert names or new.first().processed_rows == PATIENTS
    assert new.first().status == 404  # the same files again
    stored = read_predictions(spark, predictions)
    run = pipeline.scoring_job(spark, aggregated, f"{out}/feature_list", f"{out}/model", str(tmp_path / "again"), run_id="r1")
    both = stored.select("patient_id", "risk").exceptAll(run.predictions.select("patient_id", "risk"))
    assert stored.count() == PATIENTS and both.count() == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "reports" / "summary")).count() == 1


def test_weekly_job(spark, files, tmp_path):
    shown = pipeline.weekly_job(spark, str(files / "vitals.csv"), str(tmp_path / "weeks"))
    # All readings are of the first seconds of the epoch, a Thursday.
    assert shown.rows == PATIENTS and {str(r.week_start) for r in shown.head} == {"1969-12-29"}
    assert spark.read.parquet(str(tmp_path / "weeks")).agg({"readings": "sum"}).first()[0] == 7 * PATIENTS
