"""Runs that break off, recovery, the ledger of inputs, loose files, line feeds."""

import os

import pytest
from pyspark.sql import functions as F

from vitalgrid import sources
from vitalgrid.plans import bindings as B, pipeline, run_queries
from vitalgrid.sources import ledger, readers, runs, schemas as S, writers


def scored(spark, n=6):
    return writers.with_scored_at(spark.range(n).select(F.col("id").cast("string").alias("patient_id"), (F.col("id") / n).alias("score")))


def write(spark, base, reports, run_id, rows, replace=False, breaks_at=None):
    """A run; ``breaks_at`` names the sink before which it is killed."""
    folders = [writers.prediction_folder(base, run_id), *pipeline.report_folders(reports, run_id)]
    with runs.run(spark, base, run_id, folders, replace) as run:
        if breaks_at == "predictions":
            raise KeyboardInterrupt
        if breaks_at == "reports":
            pipeline.write_scores(run, rows, 0.45, None, replace)
            raise KeyboardInterrupt
        pipeline.write_scores(run, rows, 0.45, reports, replace)
        if breaks_at == "manifest":
            raise KeyboardInterrupt


def run_ids(spark, base):
    return {r.run_id for r in sources.read_predictions(spark, base).select("run_id").distinct().collect()}


@pytest.mark.parametrize("breaks_at", ["predictions", "reports", "manifest"])
def test_a_run_killed_between_sinks_is_not_seen(spark, tmp_path, breaks_at):
    base, reports = str(tmp_path / "p"), str(tmp_path / "r")
    write(spark, base, reports, "r1", scored(spark))
    with pytest.raises(KeyboardInterrupt):
        write(spark, base, reports, "r2", scored(spark), breaks_at=breaks_at)
    assert run_ids(spark, base) == {"r1"} and runs.unfinished(spark, base) == {"r2"}
    # A young mark may be that of a run still at work.
    assert sources.recover(spark, base) == []
    assert sources.recover(spark, base, older_than=0) == ["r2"]
    assert runs.unfinished(spark, base) == set() and not os.path.exists(f"{base}/run_id=r2")
    assert not os.path.exists(f"{reports}/alerts/run_id=r2") and os.path.exists(f"{reports}/alerts/run_id=r1")
    write(spark, base, reports, "r2", scored(spark))
    assert run_ids(spark, base) == {"r1", "r2"}
    rows = {r.run_id: dict(r.rows) for r in sources.manifests(spark, base).collect()}
    assert rows["r2"] == {"processed_rows": 6, "scored_rows": 6, "alerts_triggered": 3}


def test_replacing_hides_the_old_run_until_the_new_one_is_whole(spark, tmp_path):
    base, reports = str(tmp_path / "p"), str(tmp_path / "r")
    write(spark, base, reports, "r1", scored(spark))
    with pytest.raises(FileExistsError):
        write(spark, base, reports, "r1", scored(spark))
    with pytest.raises(KeyboardInterrupt):
        write(spark, base, reports, "r1", scored(spark, 3), replace=True, breaks_at="reports")
    assert run_ids(spark, base) == set()
    write(spark, base, reports, "r1", scored(spark, 3), replace=True)
    assert sources.read_predictions(spark, base).count() == 3


def test_sql_sees_finished_runs_only(spark, tmp_path):
    base = str(tmp_path / "p")
    write(spark, base, str(tmp_path / "r"), "r1", scored(spark))
    with pytest.raises(KeyboardInterrupt):
        write(spark, base, str(tmp_path / "r"), "r2", scored(spark), breaks_at="reports")
    before = spark.catalog.currentDatabase()
    sources.create_catalog(spark, str(tmp_path / "none"), base, "finished_db")
    try:
        count = lambda: {r.run_id: r.n for r in spark.sql("SELECT run_id, COUNT(*) AS n FROM heart_attack_predictions GROUP BY run_id").collect()}
        assert count() == {"r1": 6}
        sources.recover(spark, base, older_than=0)
        write(spark, base, str(tmp_path / "r"), "r2", scored(spark, 2))
        rows = scored(spark, 4).select("patient_id", F.col("score").alias("risk"), F.lit("LOW_RISK").alias("risk_status"), "scored_at")
        run_queries.write_file(S.to_file_names(rows, S.PREDICTIONS), f"{base}/loose.csv")
        sources.add_runs(spark, "finished_db")
        assert count() == {"r1": 6, "r2": 2, "loose.csv": 4}
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE finished_db CASCADE")


def test_runs_of_before_count_as_finished(spark, tmp_path):
    rows = scored(spark).select("patient_id", F.col("score").alias("risk"), F.lit("LOW_RISK").alias("risk_status"), "scored_at")
    writers.write_run(S.to_file_names(rows, S.PREDICTIONS), str(tmp_path), "old")
    (tmp_path / "run_id=old" / "x").mkdir()
    assert run_ids(spark, str(tmp_path)) == {"old"}
    assert sources.read_predictions(spark, str(tmp_path / "none")).count() == 0


def test_other_folders_and_files_are_read_too(spark, tmp_path):
    head = "Patient ID,Heart Attack Risk,Risk_Status,ScoredAt\n"
    for name in ("a.csv", "run_id=r1/b.csv", "2025/11/c.csv", "_hidden.csv"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"{head}{name[0]},0.5,LOW_RISK,t\n")
    rows = sources.read_predictions(spark, str(tmp_path)).collect()
    assert sorted((r.patient_id, r.run_id) for r in rows) == [("2", "c.csv"), ("a", "a.csv"), ("r", "r1")]


def test_a_file_is_claimed_by_one_of_two_runs(spark, tmp_path):
    inputs, base = tmp_path / "in", str(tmp_path / "p")
    inputs.mkdir()
    (inputs / "a.csv").write_text("x\n1\n")
    fresh = sources.new_files(spark, str(inputs), base)
    assert fresh.count() == 1
    one, two = (runs.Run(spark, base, r, []) for r in ("r1", "r2"))
    assert len(ledger.claim(one, fresh)) == 1 and ledger.claim(two, fresh) == []
    # The first breaks off: its claim is given back, the other's mark gives back nothing.
    assert sources.recover(spark, base, older_than=0) == ["r1", "r2"]
    three = runs.Run(spark, base, "r3", [])
    mine = ledger.claim(three, fresh)
    assert len(mine) == 1
    ledger.record(three, mine)
    three.commit()
    assert sources.new_files(spark, str(inputs), base).count() == 0
    assert [r.run_id for r in sources.entries(spark, base).collect()] == ["r3"]
    (inputs / "a.csv").write_text("x\n1\n2\n")
    assert sources.new_files(spark, str(inputs), base).count() == 1


def test_files_of_a_failed_run_are_scored_by_the_next(spark, tmp_path):
    inputs, base = tmp_path / "in", str(tmp_path / "p")
    inputs.mkdir()
    (inputs / "a.csv").write_text("Patient ID,Heart Rate\n1,60\n2,70\n")
    table = S.PROCESSED[:2]

    def scorer(rows):
        return rows.select("patient_id", (F.col("heart_rate") / 100).alias("score"))

    def broken(rows):
        raise RuntimeError("no model")

    with pytest.raises(RuntimeError):
        pipeline.score_new_files(spark, str(inputs), base, broken, table, run_id="r1")
    assert sources.read_predictions(spark, base).count() == 0
    sources.recover(spark, base, older_than=0)
    summary = pipeline.score_new_files(spark, str(inputs), base, scorer, table, run_id="r2").first()
    assert (summary.processed_rows, summary.alerts_triggered) == (2, 2)
    assert pipeline.score_new_files(spark, str(inputs), base, scorer, table, run_id="r3").first().status == 404
    assert run_ids(spark, base) == {"r2"}
    assert pipeline.score_new_files(spark, str(tmp_path / "none"), base, scorer, table).first().status == 404


def test_line_feeds(spark, tmp_path):
    rows = spark.createDataFrame([("1", "two\nlines"), ("2", " \r\n x ")], "a string, b string")
    with pytest.raises(Exception, match="line feed"):
        writers.write_run(rows, str(tmp_path / "no"), "r")
    writers.write_run(rows, str(tmp_path / "yes"), "r", line_feeds=True)
    back = sources.read_rows(spark, str(tmp_path / "yes" / "run_id=r"), **readers.LINE_FEEDS)
    assert sorted(map(tuple, back.collect())) == [("1", "two\nlines"), ("2", " \r\n x ")]


def test_bindings_have_times(spark):
    rows = B.timed_vitals(spark, "/root/testdata/sf0.001")
    assert rows.where("ts IS NULL").count() > 0 and rows.agg(F.max("ts")).first()[0].month == 4
