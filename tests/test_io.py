import os
import time

import pytest
from pyspark.sql import functions as F

from vitalgrid import session, sources
from vitalgrid.sources import schemas as S, writers

VITALS_CSV = """Patient ID,Heart Rate,BP_Systolic,BP_Diastolic,Sleep Hours Per Day,Physical Activity Per day,Timestamp
a,60,120,80,7.5,1,1763946244
a,x,121,81,6.5,0,1763946245
"""
HISTORY_CSV = """Patient ID,Sex,Age,Blood Pressure,Heart Attack Risk,Income,Notes
a,Male,40.0,130/85,1,9007199254740993,"x, y"
b,,,,,oops,
"""


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_vitals(spark, tmp_path):
    df = sources.read_vitals(spark, write(tmp_path / "v.csv", VITALS_CSV))
    assert df.schema == S.internal_schema(S.VITALS)
    assert [tuple(r) for r in df.collect()] == [
        ("a", 60.0, 120.0, 80.0, 7.5, 1, 1763946244),
        ("a", None, 121.0, 81.0, 6.5, 0, 1763946245),
    ]


def test_history_goes_by_name_not_position(spark, tmp_path):
    df = sources.read_history(spark, write(tmp_path / "h.csv", HISTORY_CSV))
    rows = [r.asDict() for r in df.collect()]
    assert rows[0] == {
        "patient_id": "a", "sex": "Male", "age": 40, "blood_pressure": "130/85",
        "heart_attack_risk": 1, "income": 9007199254740993, "Notes": "x, y",
    }
    assert rows[1]["income"] is None and rows[1]["age"] is None


def test_differing_headers_are_an_error(spark, tmp_path):
    write(tmp_path / "d" / "a.csv", "x,y\n1,2\n")
    write(tmp_path / "d" / "b.csv", "y,x\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_rows(spark, str(tmp_path / "d")).collect()


def test_processed_round_trip(spark, tmp_path):
    path = str(tmp_path / "p")
    one = spark.createDataFrame([("a", "", 1.5), ("b", "80", None)],
                                "patient_id string, blood_pressure string, sleep_hours double")
    sources.write_processed(one, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    back = sources.read_processed(spark, path, S.table_of(one))
    assert back.columns == one.columns
    assert sorted(map(tuple, back.collect())) == [("a", None, 1.5), ("b", "80", None)]
    header = next(f for f in os.listdir(path) if f.endswith(".csv"))
    assert open(os.path.join(path, header)).readline() == "Patient ID,Blood Pressure,Sleep Hours Per Day\n"


def test_pick_input(spark, tmp_path):
    assert sources.pick_input(spark, str(tmp_path)) == []
    assert sources.pick_input(spark, str(tmp_path), "latest") == []
    write(tmp_path / "sub" / "a.csv", "x\n1\n")
    time.sleep(0.05)
    write(tmp_path / "b.csv", "x\n2\n")
    write(tmp_path / "c.txt", "x\n3\n")
    os.utime(tmp_path / "sub" / "a.csv", (2e9, 2e9))
    name = lambda which: os.path.basename(sources.pick_input(spark, str(tmp_path), which)[0])
    assert name("first") == "b.csv"
    assert name("latest") == "a.csv"
    assert sources.pick_input(spark, str(tmp_path)) == [str(tmp_path)]
    # What is listed is what is read: below folders too, and CSV only.
    rows = sources.read_rows(spark, sources.pick_input(spark, str(tmp_path)), **sources.LISTING)
    assert sorted(r.x for r in rows.collect()) == ["1", "2"]
    for which in ("all", "first", "latest"):
        assert sources.pick_input(spark, str(tmp_path / "none"), which) == []


def test_quotes_in_fields(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,b,c\n1,"He said ""hi"", left",2\n')
    assert [tuple(r) for r in sources.read_rows(spark, path).collect()] == [("1", 'He said "hi", left', "2")]
    writers.write_run(sources.read_rows(spark, path), str(tmp_path / "out"), "r")
    assert sources.read_rows(spark, str(tmp_path / "out")).first().b == 'He said "hi", left'


def test_predictions_with_another_header_are_an_error(spark, tmp_path):
    write(tmp_path / "p" / "run_id=r" / "x.csv", "Risk_Status,Patient ID,Heart Attack Risk,ScoredAt\nLOW_RISK,a,0.9,t\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_predictions(spark, str(tmp_path / "p")).collect()


def test_feature_list(spark, tmp_path):
    path = write(tmp_path / "f.txt", " Age \n\nHeart Attack Risk\n\tBMI\r\nSex_Male")
    assert sources.read_feature_list(spark, path) == ["Age", "BMI", "Sex_Male"]
    out = str(tmp_path / "list")
    sources.write_feature_list(spark, ["b", "a", "c d"], out)
    assert sources.read_feature_list(spark, out) == ["b", "a", "c d"]


def test_labelled_rows_have_no_header(spark, tmp_path):
    path = str(tmp_path / "train")
    sources.write_labelled(spark.createDataFrame([(1, 2.5)], "y int, x double").coalesce(1), path)
    file = next(f for f in os.listdir(path) if f.endswith(".csv"))
    assert open(os.path.join(path, file)).read() == "1,2.5\n"


def test_prediction_runs_add_up_and_repeat_safely(spark, tmp_path):
    path = str(tmp_path / "pred")
    df = writers.with_scored_at(
        spark.createDataFrame([("a", 0.5, "HIGH_RISK")], "patient_id string, risk double, risk_status string")
    )
    assert sources.write_predictions(df, path, "r1")
    assert sources.write_predictions(df, path, "r2")
    assert sources.write_predictions(df, path, "r2", replace=True)
    assert not sources.write_predictions(df.limit(0), path, "r3")
    back = sources.read_predictions(spark, path)
    assert back.columns == ["patient_id", "risk", "risk_status", "scored_at", "run_id"]
    assert sorted(r.run_id for r in back.collect()) == ["r1", "r2"]
    assert back.select(F.try_to_timestamp("scored_at").isNotNull()).first()[0]
    with pytest.raises(Exception, match="(?i)exists"):
        sources.write_predictions(df, path, "r2")
    assert writers.new_run_id(spark) != writers.new_run_id(spark)
    assert len(writers.new_run_id(spark)) == len("20251124_010404_0123456789ab")
    plan = back.where("run_id = 'r1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


QUERY = """
SELECT d."Patient ID" AS patient_id, MAX(d.Age) AS Age, MAX(d."Blood Pressure") AS "Blood Pressure",
  MIN(from_iso8601_timestamp(s.ScoredAt)) AS first_seen, COUNT(*) AS runs
FROM heart_attack_processed_data d JOIN heart_attack_predictions s USING ("Patient ID")
GROUP BY d."Patient ID" HAVING AVG(s."Heart Attack Risk") BETWEEN 0.1 AND 0.9
"""


def test_catalog_answers_quoted_sql(spark, tmp_path):
    processed, predictions = str(tmp_path / "processed"), str(tmp_path / "predictions")
    empty = spark.createDataFrame([("a",), ("b",)], "patient_id string")
    filled = empty.select(
        *[F.col(n) if n == "patient_id" else F.lit("1").cast(t).alias(n) for _, n, t in S.PROCESSED]
    )
    sources.write_processed(filled, processed)
    scored = writers.with_scored_at(empty.selectExpr("patient_id", "0.5D risk", "'HIGH_RISK' risk_status"))
    sources.write_predictions(scored, predictions, "r1")
    sources.write_predictions(scored, predictions, "r2")
    keep = spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers")
    try:
        for _ in range(2):
            sources.create_catalog(spark, processed, predictions, "test_db")
        assert spark.catalog.currentDatabase() == "test_db"
        assert spark.sql("SELECT COUNT(*) FROM heart_attack_processed_data").first()[0] == 2
        assert spark.sql("SELECT COUNT(*) FROM heart_attack_predictions").first()[0] == 4
        spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
        rows = spark.sql(QUERY).collect()
        assert sorted((r.patient_id, r.runs) for r in rows) == [("a", 2), ("b", 2)]
        one = spark.sql("SELECT * FROM heart_attack_predictions WHERE run_id = 'r1'")
        assert one.count() == 2
        assert "PartitionFilters: [isnotnull(run_id" in one._jdf.queryExecution().executedPlan().toString()
        sources.write_predictions(scored, predictions, "r3")
        sources.add_runs(spark, "test_db")
        assert spark.sql("SELECT COUNT(*) FROM heart_attack_predictions").first()[0] == 6
        assert {(r.Age, r["Blood Pressure"]) for r in rows} == {(1, "1")}
        assert all(r.first_seen is not None for r in rows)
    finally:
        spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", keep)
        spark.catalog.setCurrentDatabase("default")


def test_shared_dir_is_the_session_setting(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_path(spark, "x") != session.new_path(spark, "x")


def test_staged_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumn("t", F.col("id").cast("string"))
    back = session.staged(df, "t")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert back.count() == 10


def test_staged_alone_keeps_the_result_only(spark):
    first = session.staged(spark.range(3), "first")
    made = []

    def make():
        made.append(session.staged(first, "one"))
        inner = session.staged_alone(spark, lambda: session.staged(made[0], "two").union(first), "inner")
        made.append(inner)
        return inner.union(first)

    result = session.staged_alone(spark, make, "result")
    assert result.count() == 9 and first.count() == 3
    names = [e.name.split("-")[0] for e in session.list_folder(spark, session.run_dir(spark))]
    assert {"first", "result"} <= set(names) and not {"one", "two", "inner"} & set(names)
    with pytest.raises(ValueError):
        session.staged_alone(spark, lambda: (_ for _ in ()).throw(ValueError()), "none")
    assert session._held == []


def test_clean_up_deletes_what_was_staged(spark, tmp_path):
    other = spark.newSession()
    path = session.new_path(other, "t")
    assert path.startswith(session.run_dir(spark))
    spark.range(1).write.parquet(path)
    # Other tests' tables are gone then too; none of them is read again here.
    session.clean_up(spark)
    assert not os.path.exists(session.run_dir(spark))


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default if key == "spark.checkpoint.dir" else "/w"

    class Context:
        def __init__(self, master):
            self.master, self.set = master, None

        def getCheckpointDir(self):
            return self.set

        def setCheckpointDir(self, path):
            self.set = path

    class Session:
        def __init__(self, master):
            self.conf, self.sparkContext = Conf(), Context(master)

    assert session.shared_dir(Session("local[4]")) == "/w/_shared"
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://h:7077"):
        with pytest.raises(ValueError, match="checkpoint"):
            session.shared_dir(Session(master))
