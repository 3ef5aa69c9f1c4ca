"""Queries over weeks, models, ranks and kept states, and their SQL twins.

The SQL uses the tables that the entry file defines in front of it.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitalgrid import config as C
from vitalgrid.operators import boosting, weeks
from vitalgrid.operators.correlation import correlations
from vitalgrid.operators.profile import DEVIATION, FREQUENT_BOUND, profile
from vitalgrid.operators.split import group_split as split_by_group
from vitalgrid.plans import bindings as B, pipeline, states
from vitalgrid.session import new_path, staged
from vitalgrid.sources import buckets
from vitalgrid.streaming import file_stream
from vitalgrid.streaming.vitals import compact, keep_weekly, read_weekly

TODAY = "2024-04-05"


def weekly_vitals_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar weeks, among them one in which clocks change, and each patient's last
    complete one."""
    by_week = staged(weeks.weekly_vitals_by_week(B.timed_vitals(spark, sf_dir), B.ZONE), "weeks")
    last = weeks.last_complete_week(by_week, F.lit(TODAY).cast("date")).select("patient_id", "week_start", F.lit(True).alias("is_last"))
    joined = by_week.join(last, ["patient_id", "week_start"], "left")
    return joined.withColumn("is_last", F.coalesce("is_last", F.lit(False)))


def weekly_vitals_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven days from every day on."""
    return weeks.weekly_vitals_by_week(B.timed_vitals(spark, sf_dir), B.ZONE, 1)


def stream_weekly_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same weeks from a stream over several files, the first of which reaches the
    end of the time, in two triggers, with the versions folded in between."""
    path, sink = new_path(spark, "arriving"), new_path(spark, "weekly")
    rows = staged(B.timed_vitals(spark, sf_dir).withColumn("part", F.xxhash64("ts", "patient_id") % 4), "timed")

    def arrive(parts: list[int]) -> None:
        for p in parts:
            rows.where(F.col("part") == p).drop("part").coalesce(1).write.mode("append").parquet(path)
        source = file_stream(spark, path, rows.drop("part").schema, maxFilesPerTrigger=1)
        keep_weekly(source, sink, B.ZONE, delay="90 days").awaitTermination()

    arrive([-3, -2, -1])
    compact(spark, sink)
    arrive([0, 1, 2, 3])
    return read_weekly(spark, sink)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.processed(spark, sf_dir).withColumn("label", F.when(F.col("cholesterol") > 6000, 1).otherwise(0))


FEATURES = ["heart_rate", "sleep_hours", "activity_days"]
CUTS = [[42.0, 46.0, 49.0, 52.0, 58.0], [4.0, 5.0, 6.0, 7.0], [9.0, 11.0, 13.0, 15.0, 17.0]]
ONE_TREE = boosting.BoostParams(rounds=1, depth=2, row_share=1.0, column_share=1.0)


def boosted_second_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits and leaf weights of one tree over fixed bins."""
    model = boosting.train(_labelled(spark, sf_dir), FEATURES, "label", ONE_TREE, CUTS)
    (tree,) = boosting.Boosted.from_json(model.to_json()).trees
    rows = [(n, FEATURES[s.feature], s.cut, round(s.gain, 6), None) for n, s in tree.splits.items()]
    rows += [(n, None, None, None, round(w, 9)) for n, w in tree.leaves.items()]
    return spark.createDataFrame(rows, "node int, feature string, cut double, gain double, weight double")


def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of a whole model's scores whatever its trees: every row has one between
    0 and 1, and the saved model gives the same. Rows and columns are drawn, bins come
    from quantiles."""
    rows = staged(_labelled(spark, sf_dir), "labelled")
    params = boosting.BoostParams(rounds=12, depth=3, bins=16)
    model = boosting.train(rows, FEATURES, "label", params)
    again = boosting.Boosted.from_json(model.to_json())
    scored = model.score(rows).withColumn("again", F.lit(0.0) + 1 / (1 + F.exp(-again.margin())))
    return scored.select("patient_id", F.col("score").between(0, 1).alias("in_range"), (F.abs(F.col("score") - F.col("again")) < 1e-12).alias("saved_agrees"))


def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a patient who stands in the table several times stay together."""
    rows = B.history(spark, sf_dir).select("patient_id", F.when(F.col("cholesterol") > 6000, 1).otherwise(0).alias("label"))
    # A few patients with very many rows.
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("patient_id") % 31 == 7, 40).otherwise(1))))
    order = B.multiplicative_order(F.col("patient_id"))
    return split_by_group(rows, "label", "patient_id", order=order)


def activity_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity and predicted risk over joined rows, both coefficients."""
    predictions, processed = B.report_tables(spark, sf_dir)
    joined = predictions.select("patient_id", "risk").join(processed.select("patient_id", "activity_days"), "patient_id")
    found = correlations(joined, "activity_days", "risk")
    return found.select("rows", F.round("pearson", 8).alias("pearson"), F.round("spearman", 8).alias("spearman"))


def history_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact figures of every column of the history, and whether those of the sketches
    keep their bounds: distinct values within four deviations, the median's rank within a
    hundredth, the count of the most frequent value within the sketch's bound."""
    rows = staged(B.history(spark, sf_dir).select("patient_id", "age", "cholesterol", "sex", "diet", "country"), "history")
    found = staged(profile(rows), "profile")
    n = rows.count()
    exact = []
    for f in rows.schema:
        c, about = F.col(f.name), found.where(F.col("column") == f.name).first()
        median = about.quantiles[1] if about.quantiles else None
        below = [F.count_if(c.cast("double") < median), F.count_if(c.cast("double") <= median)] if median is not None else [F.lit(0), F.lit(0)]
        top = about.frequent[0] if about.frequent else None
        # Without a frequent value none may have more rows than the bound.
        most = rows.groupBy(c).count().where(c.isNotNull()).agg(F.max("count")).first()[0] if top is None else 0
        exact.append(
            rows.agg(
                F.lit(f.name).alias("column"), F.lit(about.rows).alias("rows"), F.lit(about.missing).alias("missing"), F.count_distinct(c).alias("exactly"),
                F.count(c).alias("known"), below[0].alias("below"), below[1].alias("upto"), (F.count_if(c.cast("string") == top.value) if top else F.lit(most)).alias("top"),
            ).select(
                "column", "rows", "missing",
                (F.abs(F.lit(about.distinct) - F.col("exactly")) <= 4 * DEVIATION * F.col("exactly") + 1).alias("distinct_holds"),
                (F.lit(median is None) | ((F.col("below") <= F.col("known") * 0.51 + 1) & (F.col("upto") >= F.col("known") * 0.49 - 1))).alias("median_holds"),
                (F.abs(F.lit(top["count"] if top else 0) - F.col("top")) <= FREQUENT_BOUND * n + 1).alias("frequent_holds"),
            )
        )
    return reduce(DataFrame.unionByName, exact)


def _runs(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Three runs over the processed table, the last two of which replace each other."""
    stored, processed = B.report_tables(spark, sf_dir)
    stored = staged(stored.withColumn("patient_id", F.col("patient_id").cast("bigint")), "stored")
    return {
        "r1": stored.where("patient_id % 2 = 0"),
        "r2": stored.where("patient_id % 3 = 0"),
        "r2 again": stored.where("patient_id % 5 < 3"),
        "r3": stored.where("patient_id % 7 = 1"),
    }, processed


def reports_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports after runs were added and one was replaced, from parts alone."""
    runs, processed = _runs(spark, sf_dir)
    path = new_path(spark, "states")
    for name, rows in runs.items():
        states.add_run(spark, path, name.split(" ")[0], rows, processed)
    return states.as_rows(states.reports_from_states(spark, path))


def triage_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest risks after each of four changes of the runs."""
    runs, processed = _runs(spark, sf_dir)
    path, out = new_path(spark, "states"), []
    for i, (name, rows) in enumerate(runs.items(), 1):
        states.add_run(spark, path, name.split(" ")[0], rows, processed, 20)
        top = states.triage_from_states(spark, path, 20)
        out.append(staged(top.withColumn("step", F.lit(i)), "top"))
    return reduce(DataFrame.unionByName, out)


def bucketed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort reports over tables laid out by patient: two runs, one written twice."""
    runs, processed = _runs(spark, sf_dir)
    suffix = uuid.uuid4().hex[:12]
    tables = f"bucketed_processed_{suffix}", f"bucketed_runs_{suffix}"
    try:
        buckets.store(processed, tables[0], 8)
        for name in ("r1", "r2", "r2 again"):
            buckets.store_run(runs[name], tables[1], name.split(" ")[0], 8)
        found = pipeline.report_job(spark.table(tables[1]), spark.table(tables[0]), C.Settings(triage_size=20))
        return staged(states.as_rows({k: v for k, v in found.items() if k != "triage_top_risk"}), "reports")
    finally:
        for t in tables:
            buckets.drop(spark, t)


QUERIES = {
    q.__name__: q
    for q in (
        weekly_vitals_by_week,
        weekly_vitals_sliding,
        stream_weekly_vitals,
        boosted_second_order,
        boosted_scores,
        group_split,
        activity_correlation,
        history_profile,
        reports_from_states,
        triage_maintained,
        bucketed_reports,
    )
}

_TIMED = """
timed AS (
  SELECT v.*, TIMEZONE('Europe/Berlin', (e.ts + INTERVAL 70 DAY) AT TIME ZONE 'UTC') AS clock
  FROM (SELECT event_id, CASE WHEN user_id % 10 = 3 THEN user_id + 1000000000 ELSE user_id END AS patient_id, value AS heart_rate,
          100 + event_id % 71 AS bp_systolic, 60 + event_id % 61 AS bp_diastolic,
          CASE WHEN user_id % 29 = 5 THEN NULL ELSE CAST(3 + user_id % 6 + (event_id % 10) / 10.0 AS DOUBLE) END AS sleep_hours,
          CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS physical_activity FROM events) v
  JOIN events e ON e.event_id = v.event_id WHERE e.event_id % 97 <> 13),
profiles AS (
  SELECT patient_id, week_start,
    CAST(ROUND(CAST(AVG(heart_rate) AS DECIMAL(20,8)), 0) AS DOUBLE) AS heart_rate,
    CAST(ROUND(CAST(AVG(bp_systolic) AS DECIMAL(20,8)), 0) AS INT) AS bp_s,
    CAST(ROUND(CAST(AVG(bp_diastolic) AS DECIMAL(20,8)), 0) AS INT) AS bp_d,
    CAST(ROUND(CAST(AVG(sleep_hours) AS DECIMAL(20,8)), 2) AS DOUBLE) AS sleep_hours,
    CAST(SUM(physical_activity) AS BIGINT) AS activity_days, COUNT(*) AS readings
  FROM dated GROUP BY patient_id, week_start)
"""
_BY_WEEK = "dated AS (SELECT *, CAST(DATE_TRUNC('week', clock) AS DATE) AS week_start FROM timed)"
_BY_DAY = "dated AS (SELECT *, CAST(clock AS DATE) - CAST(k AS INT) AS week_start FROM timed, RANGE(7) r(k))"


def _profiles(dated: str, select: str) -> str:
    timed, profiles = _TIMED.split("profiles AS")
    return f", {timed.strip()} {dated}, profiles AS{profiles} {select}"


def _tree_sql() -> str:
    """One tree of two levels: of each node the best of all cuts."""
    cuts = ", ".join(f"({f}, {b}, CAST({c} AS DOUBLE))" for f, cs in enumerate(CUTS) for b, c in enumerate(cs))
    names = ", ".join(f"({i}, '{n}')" for i, n in enumerate(FEATURES))
    steps = [f""", cuts(f, b, cut) AS (VALUES {cuts}), names(f, feature) AS (VALUES {names}),
at0 AS (SELECT 0 AS node, heart_rate AS x0, COALESCE(sleep_hours, 0) AS x1, CAST(activity_days AS DOUBLE) AS x2,
          0.5::DOUBLE - CASE WHEN cholesterol > 6000 THEN 1 ELSE 0 END AS g, 0.25::DOUBLE AS h FROM processed)"""]
    for level in (0, 1):
        steps.append(f"""
sums{level} AS (
  SELECT node, f, b, cut, SUM(CASE WHEN x <= cut THEN g ELSE 0 END) AS gl, SUM(CASE WHEN x <= cut THEN h ELSE 0 END) AS hl, SUM(g) AS ga, SUM(h) AS ha
  FROM (SELECT a.*, c.*, CASE f WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END AS x FROM at{level} a, cuts c) t GROUP BY node, f, b, cut),
split{level} AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY node ORDER BY gain DESC, f, b) AS place
    FROM (SELECT *, ROUND((gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)) / 2, 9) AS gain
          FROM sums{level} WHERE hl >= 1 AND ha - hl >= 1) r) s WHERE place = 1 AND gain > 0),
at{level + 1} AS (
  SELECT CASE WHEN CASE f WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END <= cut THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node, x0, x1, x2, g, h
  FROM at{level} a JOIN split{level} s ON a.node = s.node)""")
    return ",".join(steps) + """
SELECT CAST(node AS INT) AS node, feature, cut, ROUND(gain, 6) AS gain, CAST(NULL AS DOUBLE) AS weight
FROM (SELECT * FROM split0 UNION ALL SELECT * FROM split1) s JOIN names n ON s.f = n.f
UNION ALL
SELECT CAST(node AS INT), NULL, NULL, NULL, ROUND(-0.1 * SUM(g) / (SUM(h) + 1), 9)
FROM (SELECT * FROM at0 WHERE node NOT IN (SELECT node FROM split0) UNION ALL SELECT * FROM at1 WHERE node NOT IN (SELECT node FROM split1) UNION ALL SELECT * FROM at2) l
GROUP BY node
"""


_RUN_ROWS = ", runs AS ({})"


def _run_rows(*conditions: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM pred WHERE {c}" for c in conditions)


_REPORTS = """, j AS (SELECT p.risk, d.age, d.sleep_hours, d.activity_days, d.heart_rate FROM runs p JOIN processed d ON p.patient_id = d.patient_id),
figures AS (
  SELECT 'high_risk_count' AS report, NULL AS bucket, 'high_risk_count' AS figure, CAST(COUNT(*) AS DOUBLE) AS value FROM runs WHERE risk > 0.45
  UNION ALL SELECT 'risk_by_age_band', age_group, figure, CASE figure WHEN 'patients' THEN n ELSE r END
  FROM (SELECT CASE WHEN age < 30 THEN '20-29' WHEN age BETWEEN 30 AND 39 THEN '30-39' WHEN age BETWEEN 40 AND 49 THEN '40-49'
              WHEN age BETWEEN 50 AND 59 THEN '50-59' WHEN age BETWEEN 60 AND 69 THEN '60-69' ELSE '70+' END AS age_group,
          CAST(ROUND(CAST(AVG(risk) AS DECIMAL(20,8)), 3) AS DOUBLE) AS r, COUNT(*) AS n FROM j GROUP BY 1) a, (VALUES ('patients'), ('avg_predicted_risk')) f(figure)
  UNION ALL SELECT 'risk_by_sleep_bucket', bucket, figure, CASE figure WHEN 'patients' THEN n WHEN 'avg_sleep' THEN s ELSE r END
  FROM (SELECT CAST(CAST(FLOOR(sleep_hours) AS BIGINT) AS VARCHAR) AS bucket, CAST(ROUND(CAST(AVG(risk) AS DECIMAL(20,8)), 3) AS DOUBLE) AS r,
          CAST(ROUND(CAST(AVG(sleep_hours) AS DECIMAL(20,8)), 2) AS DOUBLE) AS s, COUNT(*) AS n FROM j GROUP BY 1) b,
       (VALUES ('patients'), ('avg_predicted_risk'), ('avg_sleep')) f(figure)
  UNION ALL SELECT 'activity_overview', NULL, figure, CASE figure WHEN 'avg_activity_days' THEN a WHEN 'avg_heart_rate' THEN h ELSE r END
  FROM (SELECT CAST(ROUND(CAST(AVG(activity_days) AS DECIMAL(20,8)), 2) AS DOUBLE) AS a, CAST(ROUND(CAST(AVG(heart_rate) AS DECIMAL(20,8)), 1) AS DOUBLE) AS h,
          CAST(ROUND(CAST(AVG(risk) AS DECIMAL(20,8)), 3) AS DOUBLE) AS r FROM j) c, (VALUES ('avg_activity_days'), ('avg_heart_rate'), ('avg_predicted_risk')) f(figure))
SELECT report, bucket, figure, CAST(value AS DOUBLE) AS value FROM figures
"""

_TRIAGE = """SELECT {step} AS step, p.patient_id, p.risk AS predicted_risk, p.risk_status, CAST(p.scored_at AS TIMESTAMP) AS scored_at,
  d.age, d.sex, d.cholesterol, d.blood_pressure, d.country
FROM ({rows}) p LEFT JOIN processed d ON p.patient_id = d.patient_id ORDER BY p.risk DESC, p.patient_id LIMIT 20"""
_STEPS = [
    ["patient_id % 2 = 0"],
    ["patient_id % 2 = 0", "patient_id % 3 = 0"],
    ["patient_id % 2 = 0", "patient_id % 5 < 3"],
    ["patient_id % 2 = 0", "patient_id % 5 < 3", "patient_id % 7 = 1"],
]

SQL = {
    "weekly_vitals_by_week": _profiles(
        _BY_WEEK,
        f"SELECT *, COALESCE(week_start = MAX(CASE WHEN week_start + 7 <= DATE '{TODAY}' THEN week_start END) OVER (PARTITION BY patient_id), FALSE) AS is_last FROM profiles",
    ),
    "weekly_vitals_sliding": _profiles(_BY_DAY, "SELECT * FROM profiles"),
    "stream_weekly_vitals": _profiles(_BY_WEEK, "SELECT * FROM profiles"),
    "boosted_second_order": _tree_sql(),
    "boosted_scores": "SELECT patient_id, TRUE AS in_range, TRUE AS saved_agrees FROM processed",
    "group_split": """, h AS (
  SELECT patient_id, CASE WHEN cholesterol > 6000 THEN 1 ELSE 0 END AS label, CAST(copy AS INT) AS copy
  FROM demo, RANGE(1, 41) r(copy) WHERE copy = 1 OR patient_id % 31 = 7),
g AS (SELECT patient_id, MAX(label) AS cls, COUNT(*) AS n, (patient_id * 2654435761) % 4294967296 AS o FROM h GROUP BY patient_id),
p AS (SELECT patient_id, CASE WHEN SUM(n) OVER (PARTITION BY cls ORDER BY o, patient_id) - n < CEIL(SUM(n) OVER (PARTITION BY cls) * 0.2) THEN 'test' ELSE 'train' END AS part FROM g)
SELECT h.patient_id, label, copy, part FROM h JOIN p ON h.patient_id = p.patient_id
""",
    "activity_correlation": """, j AS (SELECT CAST(d.activity_days AS DOUBLE) AS x, p.risk AS y FROM pred p JOIN processed d ON p.patient_id = d.patient_id),
r AS (SELECT x, y, RANK() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, RANK() OVER (ORDER BY y) + (COUNT(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM j)
SELECT COUNT(*) AS rows, ROUND(CORR(x, y), 8) AS pearson, ROUND(CORR(rx, ry), 8) AS spearman FROM r
""",
    "history_profile": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS missing, TRUE AS distinct_holds, TRUE AS median_holds, TRUE AS frequent_holds FROM demo"
        for c in ("patient_id", "age", "cholesterol", "sex", "diet", "country")
    ),
    "reports_from_states": _RUN_ROWS.format(_run_rows(*_STEPS[3])) + _REPORTS,
    "bucketed_reports": _RUN_ROWS.format(_run_rows(*_STEPS[2])) + _REPORTS,
    "triage_maintained": "\nUNION ALL ".join(f"SELECT * FROM ({_TRIAGE.format(step=f'CAST({i} AS INT)', rows=_run_rows(*s))}) t{i}" for i, s in enumerate(_STEPS, 1)),
}
