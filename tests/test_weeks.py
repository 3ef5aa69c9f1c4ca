"""Calendar weeks, streams of them, and what is kept of runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import weeks as W
from vitalgrid.operators.correlation import correlations
from vitalgrid.operators.joins import lookup
from vitalgrid.operators.ranking import rank_area, ranked_groups
from vitalgrid.operators.split import group_split
from vitalgrid.plans import bindings as B, reports
from vitalgrid.plans.analysis_queries import _runs
from vitalgrid.sources import buckets
from vitalgrid.streaming import file_stream
from vitalgrid.streaming.vitals import compact, keep_weekly, read_states, read_weekly

SCHEMA = "patient_id bigint, heart_rate double, bp_systolic double, bp_diastolic double, sleep_hours double, physical_activity int, ts timestamp"


def utc(*a):
    return dt.datetime(*a, tzinfo=dt.timezone.utc)


def readings(spark, rows):
    return spark.createDataFrame([(p, rate, 120.0, 80.0, 7.0, 1, ts) for p, rate, ts in rows], SCHEMA)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_weeks_go_from_monday_to_monday_on_the_local_clock(spark, zone):
    rows = [
        (1, 60.0, utc(2024, 3, 24, 22, 59)), (1, 70.0, utc(2024, 3, 24, 23, 0)),  # Sunday's end in Berlin, winter
        (1, 80.0, utc(2024, 3, 31, 21, 59)), (1, 90.0, utc(2024, 3, 31, 22, 0)),  # and in summer
        (2, 50.0, None),
    ]
    keep = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = W.weekly_vitals_by_week(readings(spark, rows), "Europe/Berlin").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", keep)
    assert sorted((str(r.week_start), r.heart_rate, r.readings) for r in got) == [
        ("2024-03-18", 60.0, 1), ("2024-03-25", 75.0, 2), ("2024-04-01", 90.0, 1)]


def test_sliding_windows_hold_seven_days(spark):
    got = W.weekly_vitals_by_week(readings(spark, [(1, 60.0, utc(2024, 3, 31, 12))]), "Europe/Berlin", 1).collect()
    assert sorted(str(r.week_start) for r in got) == [f"2024-03-{d}" for d in range(25, 32)]


def test_last_complete_week(spark):
    rows = [(1, 60.0, utc(2024, 3, 20)), (1, 61.0, utc(2024, 3, 27)), (1, 62.0, utc(2024, 4, 3)), (2, 63.0, utc(2024, 4, 3))]
    by_week = W.weekly_vitals_by_week(readings(spark, rows), "UTC")
    for today, want in (("2024-04-01", {1: 61.0}), ("2024-03-31", {1: 60.0}), ("2024-04-08", {1: 62.0, 2: 63.0}), ("2024-01-01", {})):
        last = W.last_complete_week(by_week, F.lit(today).cast("date")).collect()
        assert {r.patient_id: r.heart_rate for r in last} == want


def arrive(spark, path, sink, rows, delay):
    readings(spark, rows).coalesce(1).write.mode("append").parquet(path)
    source = file_stream(spark, path, readings(spark, []).schema, maxFilesPerTrigger=1)
    keep_weekly(source, sink, "UTC", delay).awaitTermination()


def test_a_stream_goes_on_from_its_checkpoint_and_takes_late_readings(spark, tmp_path):
    path, sink = str(tmp_path / "in"), str(tmp_path / "out")
    files = [
        [(1, 60.0, utc(2024, 3, 26)), (2, 50.0, utc(2024, 3, 26))],
        [(1, 70.0, utc(2024, 4, 5))],
        [(1, 80.0, utc(2024, 3, 27)), (3, 55.0, utc(2024, 3, 28))],  # late
    ]
    for i, rows in enumerate(files):
        arrive(spark, path, sink, rows, "30 days")
        want = W.weekly_vitals_by_week(readings(spark, sum(files[: i + 1], [])), "UTC")
        assert sorted(read_weekly(spark, sink).collect()) == sorted(want.select(read_weekly(spark, sink).columns).collect())
        if i == 1:
            before = sorted(read_states(spark, sink).collect())
            compact(spark, sink)
            assert sorted(read_states(spark, sink).collect()) == before
    # Only changed patients are written: the last version has no row of patient 2.
    assert spark.read.parquet(f"{sink}/states").where("patient_id = 2").count() == 1


def test_readings_behind_the_watermark_are_left_out(spark, tmp_path):
    path, sink = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, path, sink, [(1, 60.0, utc(2024, 3, 26))], "1 day")
    arrive(spark, path, sink, [(1, 70.0, utc(2024, 4, 20))], "1 day")
    arrive(spark, path, sink, [(1, 90.0, utc(2024, 3, 27))], "1 day")
    assert sorted((str(r.week_start), r.heart_rate) for r in read_weekly(spark, sink).collect()) == [("2024-03-25", 60.0), ("2024-04-15", 70.0)]


def test_ranks_with_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (2.0,), (5.0,), (None,)], "x double").repartition(3)
    assert {r.x: (r.n, r.mean_rank) for r in ranked_groups(df, "x").collect()} == {1.0: (1, 1.0), 2.0: (3, 3.0), 5.0: (1, 5.0)}


def test_rank_area(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, None)]
    df = spark.createDataFrame(rows, "y int, score double")
    r = rank_area(df, "y").first()
    assert (r.auc, r.rows, r.positives) == (pytest.approx(3.5 / 4), 4, 2)
    for one in (df.where("y = 1"), df.limit(0)):
        assert rank_area(one, "y").first().auc is None
    text = rank_area(df, "y")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text


def test_correlations(spark):
    big = 1e9  # a mean that would swamp plain sums
    df = spark.range(1000).selectExpr(f"{big}D + id AS x", f"{big}D - id * id AS y").repartition(4)
    r = correlations(df, "x", "y").first()
    assert r.spearman == pytest.approx(-1) and r.pearson == pytest.approx(-0.96825, abs=1e-4)
    odd = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (None, 3.0), (1.0, float("nan"))], "x double, y double")
    r = correlations(odd, "x", "y").first()
    assert (r.rows, r.pearson, r.spearman) == (2, None, None)
    assert correlations(odd.limit(0), "x", "y").first().rows == 0


def test_lookup_by_both_ways(spark):
    left = spark.createDataFrame([(None if i % 7 == 0 else i % 5, i) for i in range(200)], "k int, i int")
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.sum("i").alias("s")).withColumnRenamed("k", "key")
    want = sorted(map(repr, lookup(left, right, "k", "key", "n").collect()))
    assert len(want) == 200
    for hot_keys in (0, 4, 6):
        assert sorted(map(repr, lookup(left, right, "k", "key", "n", hot_keys).collect())) == want


def test_group_split_keeps_keys_whole(spark):
    rows = [(k, int(k % 4 == 0), i) for k in range(300) for i in range(1 + (k % 3) + (200 if k == 7 else 0))]
    rows += [(None, 0, i) for i in range(5)]
    df = spark.createDataFrame(rows, "k int, y int, i int").repartition(6)
    out = group_split(df, "y", "k", 0.2).collect()
    assert len(out) == len(rows)
    parts = {}
    for r in out:
        parts.setdefault(r.k, set()).add(r.part)
    assert all(len(p) == 1 for p in parts.values()) and len(parts) == 301
    for y in (0, 1):
        n = sum(r.y == y for r in out)
        test = sum(r.y == y and r.part == "test" for r in out)
        most = max(sum(r.k == k for r in out) for k in {r.k for r in out if r.y == y and r.part == "test"})
        assert 0.2 * n <= test < 0.2 * n + most


def test_bucketed_tables_meet_without_an_exchange(spark):
    runs, processed = _runs(spark, "/root/testdata/sf0.001")
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buckets.store(processed, "plan_processed", 4)
        buckets.store_run(runs["r1"], "plan_runs", "r1", 4)
        buckets.store_run(runs["r3"], "plan_runs", "r3", 4)
        predictions, details = spark.table("plan_runs"), spark.table("plan_processed")
        for report in (reports.risk_by_age_band, reports.risk_by_sleep_bucket, reports.activity_overview):
            text = report(predictions, details)._jdf.queryExecution().executedPlan().toString()
            below = text[text.index("SortMergeJoin") :]
            assert "Exchange" not in below, text
        one = predictions.where("run_id = 'r1'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(run_id" in one
        buckets.store_run(runs["r3"].limit(1), "plan_runs", "r3", 4)
        assert {r.run_id: r["count"] for r in spark.table("plan_runs").groupBy("run_id").count().collect()} == {"r1": runs["r1"].count(), "r3": 1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
        for t in ("plan_processed", "plan_runs"):
            buckets.drop(spark, t)


def test_timed_vitals_need_no_other_columns(spark):
    text = W.weekly_vitals_by_week(B.timed_vitals(spark, "/root/testdata/sf0.001"), B.ZONE)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in text and text.count("Exchange hashpartitioning") == 1
