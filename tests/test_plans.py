"""Shape of the physical plans."""

import re

import pytest

import __spark_entry__ as entry
from vitalgrid.operators.scoring import alerts, row_cap
from vitalgrid.plans import bindings as B, reports

SF = "/root/testdata/sf0.01"
NO_MODEL = sorted(n for n in entry.QUERIES if not n.startswith("gbt_"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_MODEL)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", text)
    # A window without a partition would be one task.
    assert not re.search(r"windowspecdefinition\(\w+#\d+L? (ASC|DESC)", text)


def test_vitals_are_scanned_once_and_pruned(spark):
    text = plan(B.processed(spark, SF))
    assert text.count("events.parquet") == 1
    schema = re.search(r"events\.parquet.*?ReadSchema: (\S+)", text, re.S).group(1)
    assert "props" not in schema and "ts:" not in schema
    assert "partial_avg" in text


def test_a_patient_filter_reaches_both_scans(spark):
    text = plan(B.processed(spark, SF).where("patient_id = 7"))
    assert "EqualTo(c_custkey,7)" in text
    events = re.search(r"PushedFilters|Filter .*user_id", text)
    assert events


def test_unused_columns_are_not_aggregated(spark):
    text = plan(B.processed(spark, SF).select("patient_id", "sleep_hours"))
    assert "bp_systolic" not in text and "c_acctbal" not in text


def test_triage_shuffles_neither_table(spark):
    predictions, processed = B.report_tables(spark, SF)
    text = plan(reports.triage_top_risk(predictions, processed, 20))
    assert "TakeOrderedAndProject" in text and "BroadcastHashJoin" in text
    # The only exchange is the broadcast of the top rows.
    assert re.findall(r"(\w*Exchange) ", text) == ["BroadcastExchange"]


def test_row_cap_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(row_cap(B.scored(spark, SF), ["patient_id"], 50))


def test_split_moves_no_rows(spark):
    text = plan(entry.queries()["stratified_split"](spark, SF))
    # The one cut per class is broadcast; only rows at a cut are moved, to number them.
    clear = text.split(":- ")[1]
    assert "Exchange" not in clear.split("BroadcastHashJoin")[0] and "BroadcastHashJoin" in text


def test_alerts_are_a_projection_of_scores(spark):
    scored, _ = B.report_tables(spark, SF)
    text = plan(alerts(scored.withColumnRenamed("risk", "score")))
    assert "Exchange" not in text


def test_reports_combine_before_they_shuffle(spark):
    text = plan(reports.risk_by_age_band(*B.report_tables(spark, SF)))
    assert text.count("partial_sum(") >= 1 and "SinglePartition" not in text


def test_age_bands_shuffle_each_side_once(spark):
    predictions, processed = B.report_tables(spark, SF)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(reports.risk_by_age_band(predictions, processed))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    by_patient = re.findall(r"Exchange hashpartitioning\(patient_id", text)
    assert len(by_patient) == 2 and "SortMergeJoin" in text


def test_row_counts_write_nothing(spark, tmp_path):
    text = plan(entry.queries()["table_row_counts"](spark, SF))
    assert "events.parquet" in text and "staged-" not in text
