"""Reports against SQL over the joined rows, with repeated and missing patients."""

import random

import pytest

from vitalgrid.operators import digest, scoring
from vitalgrid.plans import reports


def tables(spark, seed):
    rng = random.Random(seed)
    pred = [
        (rng.choice([None, *range(12)]), rng.choice([None, round(rng.random(), 6), 0.45]),
         "LOW_RISK", rng.choice(["2025-11-24T01:04:04Z", "bad"]))
        for _ in range(60)
    ] + [(3, round(rng.random(), 6), "HIGH_RISK", "2025-11-24T01:04:04Z") for _ in range(40)]
    proc = [
        (rng.choice([None, *range(5, 20)]), rng.choice([None, *range(10, 90)]),
         rng.choice([None, round(rng.uniform(3, 9), 2)]), rng.choice([None, 1, 5]),
         rng.choice([None, 60.0, 75.5]))
        for _ in range(50)
    ] + [(3, 33, 6.5, 2, 66.0)] * 30
    p = spark.createDataFrame(pred, "patient_id int, risk double, risk_status string, scored_at string")
    d = spark.createDataFrame(
        proc, "patient_id int, age int, sleep_hours double, activity_days int, heart_rate double"
    ).selectExpr("*", "'m' sex", "1.0D cholesterol", "'1/2' blood_pressure", "'X' country")
    p.createOrReplaceTempView("p")
    d.createOrReplaceTempView("d")
    return p, d


def same(got, want):
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))


R = "CAST(ROUND(CAST(AVG({}) AS DECIMAL(20,8)), {}) AS DOUBLE)".format


@pytest.mark.parametrize("seed", range(3))
def test_reports_count_joined_rows(spark, seed):
    p, d = tables(spark, seed)
    same(
        reports.risk_by_age_band(p, d),
        spark.sql(
            f"""SELECT CASE WHEN age < 30 THEN '20-29' WHEN age < 40 THEN '30-39'
                WHEN age < 50 THEN '40-49' WHEN age < 60 THEN '50-59'
                WHEN age < 70 THEN '60-69' ELSE '70+' END g, {R('risk', 3)}, COUNT(*)
                FROM p JOIN d USING (patient_id) GROUP BY 1"""
        ),
    )
    same(
        reports.risk_by_sleep_bucket(p, d),
        spark.sql(
            f"""SELECT FLOOR(sleep_hours), {R('sleep_hours', 2)}, {R('risk', 3)}, COUNT(*)
                FROM p JOIN d USING (patient_id) GROUP BY 1"""
        ),
    )
    same(
        reports.activity_overview(p, d),
        spark.sql(
            f"""SELECT {R('activity_days', 2)}, {R('heart_rate', 1)}, {R('risk', 3)}
                FROM p JOIN d USING (patient_id)"""
        ),
    )


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("limit", [1, 7, 40, 5000, 50_000])
def test_triage_keeps_the_first_rows_of_the_left_join(spark, seed, limit):
    p, d = tables(spark, seed)
    got = reports.triage_top_risk(p, d, limit)
    want = spark.sql(
        f"""SELECT p.patient_id, risk, risk_status, try_to_timestamp(scored_at),
                age, sex, cholesterol, blood_pressure, country
            FROM p LEFT JOIN d ON p.patient_id = d.patient_id
            ORDER BY risk DESC NULLS LAST, p.patient_id NULLS LAST LIMIT {limit}"""
    )
    got, want = list(map(tuple, got.collect())), list(map(tuple, want.collect()))
    # Rows of equal risk and patient have no order among them.
    assert [r[:2] for r in got] == [r[:2] for r in want]
    if limit >= 5000:
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_nan_ranks_last_and_stays_out_of_averages(spark):
    nan = float("nan")
    p = spark.createDataFrame(
        [(1, 0.2, "L", "x"), (2, nan, "L", "x"), (3, 0.9, "H", "x"), (4, None, "L", "x")],
        "patient_id int, risk double, risk_status string, scored_at string",
    )
    d = spark.createDataFrame(
        [(i, 30, 6.5, 1, 60.0, "m", 1.0, "1/2", "X") for i in range(1, 5)],
        "patient_id int, age int, sleep_hours double, activity_days int, heart_rate double, sex string, "
        "cholesterol double, blood_pressure string, country string",
    )
    assert reports.high_risk_count(p).first()[0] == 1
    for limit in (4, 20_000):
        assert [r.patient_id for r in reports.triage_top_risk(p, d, limit).collect()] == [3, 1, 2, 4]
    assert reports.risk_by_age_band(p, d).first().avg_predicted_risk == 0.55
    assert reports.risk_by_sleep_bucket(p, d).first().avg_predicted_risk == 0.55
    assert reports.activity_overview(p, d).first().avg_predicted_risk == 0.55


def test_buckets_come_in_order_with_unknown_last(spark):
    p, d = tables(spark, 0)
    floors = [r.sleep_hours_floor for r in reports.risk_by_sleep_bucket(p, d).collect()]
    assert floors[-1] is None and floors[:-1] == sorted(floors[:-1])


def test_count_uses_the_stored_risk(spark):
    scored = spark.createDataFrame(
        [("a", 0.45), ("b", 0.4500000001), ("c", 0.46), ("d", None), ("e", float("nan"))],
        "patient_id string, score double",
    )
    stored = scoring.predictions(scored)
    status = {r.patient_id: r.risk_status for r in stored.collect()}
    assert status == {"a": "LOW_RISK", "b": "HIGH_RISK", "c": "HIGH_RISK", "e": "LOW_RISK"}
    assert reports.high_risk_count(stored).first().high_risk_count == 1
    summary = digest.run_summary(scored).first()
    assert tuple(summary) == (5, 4, 2)
    assert scoring.alerts(scored).count() == summary.alerts_triggered


def test_digest_pages_hold_every_alert(spark):
    scored = spark.createDataFrame(
        [(i, 0.5 + i / 1000) for i in range(25)], "patient_id int, score double"
    )
    alerts = scoring.alerts(scored)
    rows = digest.alert_lines(alerts)
    assert [tuple(r) for r in rows.orderBy("n").collect()] == [
        (i + 1, 25, f"{i}: {round(0.5 + i / 1000, 3)}") for i in range(25)
    ]
    one = digest.alert_messages(rows, None).collect()
    assert len(one) == 1 and one[0].alerts == 25
    lines = one[0].message.split("\n")
    assert lines[0] == "25 High-Risk Patients Detected:"
    assert lines[1:] == [f"{i}: {round(0.5 + i / 1000, 3)}" for i in range(25)]
    pages = sorted(digest.alert_messages(rows, 10).collect(), key=lambda r: r.page)
    assert [r.page for r in pages] == [0, 1, 2] and {r.alerts for r in pages} == {25}
    assert "\n".join(r.message for r in pages) == one[0].message


def test_no_alerts_no_digest(spark):
    scored = spark.createDataFrame([("a", 0.1)], "patient_id string, score double")
    assert digest.alert_messages(digest.alert_lines(scoring.alerts(scored)), None).count() == 0


def test_empty_run_has_a_summary(spark):
    scored = spark.createDataFrame([], "patient_id string, score double")
    assert tuple(digest.run_summary(scored).first()) == (0, 0, 0)


def test_row_cap_and_fallback_id(spark):
    df = spark.createDataFrame([(i,) for i in range(30, 0, -1)], "line int").repartition(4)
    assert scoring.row_cap(df, ["line"], None) is df
    assert [r.line for r in scoring.row_cap(df, ["line"], 3).collect()] == [1, 2, 3]
    ids = {r.line: r["Patient ID"] for r in scoring.with_fallback_id(df, ["line"]).collect()}
    assert ids == {i: f"Row{i}" for i in range(1, 31)}
    named = df.withColumnRenamed("line", "Patient ID")
    assert scoring.with_fallback_id(named, ["Patient ID"]) is named
