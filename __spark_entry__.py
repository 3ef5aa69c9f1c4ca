"""

The SQL is that of FIXTURES.md part B, with more keys for operators that file leaves
to tests. It runs on DuckDB over the same parquet tables.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# The package lies next to this file, wherever it is loaded from.
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitalgrid.plans import analysis_queries, catalogue, run_queries

QUERIES = catalogue.QUERIES | run_queries.QUERIES | analysis_queries.QUERIES

# The training-data operators and their pipeline are an optional subpackage.
try:
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL
    from corpus_pipeline import run as run_pipeline
    from vitalgrid.llm.queries import ORACLE_SQL as LLM_SQL
    from vitalgrid.llm.queries import QUERIES as LLM_QUERIES
except ImportError as missing:
    # Deleted, or without a library of its own; the queries below stand without it.
    if missing.name not in ("corpus_pipeline", "vitalgrid.llm", "vitalgrid.llm.queries"):
        warnings.warn(f"training-data operators are left out: {missing}", stacklevel=1)
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = LLM_QUERIES | {"pipeline": run_pipeline}
    LLM_SQL = LLM_SQL | ({"pipeline": PIPELINE_SQL} if PIPELINE_SQL else {})

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Highest-risk patients: scan, aggregate, join, score, top-k."""
    return QUERIES["triage_top_risk"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    """Of a trained model, what holds whatever its trees are."""
    return {name: f"{PRELUDE}\n{body}" for name, body in (BODIES | run_queries.SQL | analysis_queries.SQL).items()} | LLM_SQL


PRELUDE = """
WITH vitals AS (
  SELECT CASE WHEN user_id % 10 = 3 THEN user_id + 1000000000 ELSE user_id END AS patient_id, value AS heart_rate,
         100 + event_id % 71 AS bp_systolic, 60 + event_id % 61 AS bp_diastolic,
         CASE WHEN user_id % 29 = 5 THEN NULL
              ELSE CAST(3 + user_id % 6 + (event_id % 10) / 10.0 AS DOUBLE) END AS sleep_hours,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS physical_activity
  FROM events),
demo AS (
  SELECT c_custkey AS patient_id,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 18 + c_custkey % 65 END AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS sex,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Unhealthy'
              WHEN c_mktsegment = 'FURNITURE' THEN 'Healthy' ELSE 'Average' END AS diet,
         c_acctbal AS cholesterol, n_name AS country, r_name AS continent
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
                JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c ON copy = 1 OR c_custkey % 23 = 4),
weekly AS (
  SELECT patient_id,
         CAST(ROUND(CAST(AVG(heart_rate) AS DECIMAL(20,8)), 0) AS DOUBLE) AS heart_rate,
         CAST(ROUND(CAST(AVG(bp_systolic) AS DECIMAL(20,8)), 0) AS INT) AS bp_s,
         CAST(ROUND(CAST(AVG(bp_diastolic) AS DECIMAL(20,8)), 0) AS INT) AS bp_d,
         CAST(ROUND(CAST(AVG(sleep_hours) AS DECIMAL(20,8)), 2) AS DOUBLE) AS sleep_hours,
         CAST(SUM(physical_activity) AS BIGINT) AS activity_days
  FROM vitals GROUP BY patient_id),
processed AS (
  SELECT w.patient_id, heart_rate, sleep_hours, activity_days,
         CONCAT_WS('/', CAST(bp_s AS STRING), CAST(bp_d AS STRING)) AS blood_pressure,
         age, sex, diet, cholesterol, country, continent
  FROM weekly w LEFT JOIN demo m ON w.patient_id = m.patient_id),
scored AS (
  SELECT patient_id,
         1 / (1 + EXP(-(-2.0 + 0.02 * heart_rate + 0.1 * COALESCE(sleep_hours, 0.0)
           + CASE WHEN LOWER(sex) = 'male' THEN 0.3 ELSE 0.0 END
           - CAST(0.01 AS DOUBLE) * activity_days))) AS score
  FROM processed),
pred AS (
  SELECT patient_id, CAST(ROUND(CAST(score AS DECIMAL(20,8)), 6) AS DOUBLE) AS risk,
         CASE WHEN score > 0.45 THEN 'HIGH_RISK' ELSE 'LOW_RISK' END AS risk_status,
         CONCAT('2025-11-24T01:04:', LPAD(CAST(patient_id % 60 AS STRING), 2, '0'), 'Z') AS scored_at
  FROM scored),
gaps AS (
  SELECT patient_id, score, CASE patient_id % 7 WHEN 1 THEN 'null' WHEN 2 THEN 'nan' ELSE 'number' END AS kind FROM scored),
dirty AS (
  SELECT c_custkey AS patient_id,
         CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '120' WHEN 2 THEN 'abc/80'
              WHEN 3 THEN '120/80/x' WHEN 4 THEN ' 118 / 77 ' ELSE '131/85' END AS bp,
         CASE c_custkey % 5 WHEN 0 THEN 'oops' WHEN 1 THEN '' WHEN 2 THEN NULL
              ELSE CAST(c_acctbal AS STRING) END AS cholesterol_txt,
         CASE c_custkey % 3 WHEN 0 THEN 'MALE' WHEN 1 THEN 'Female' ELSE NULL END AS sex,
         CASE c_custkey % 4 WHEN 0 THEN 'healthy' WHEN 1 THEN 'Unhealthy' WHEN 2 THEN 'Average' ELSE NULL END AS diet,
         CASE WHEN c_acctbal > 6000 THEN 1 ELSE 0 END AS label
  FROM customer)
"""

BODIES = {
    "weekly_vitals": """
SELECT patient_id, heart_rate, bp_s, bp_d, sleep_hours, activity_days FROM weekly
""",
    "processed_health": """
SELECT * FROM processed
""",
    "bp_split": """
SELECT patient_id,
  TRY_CAST(CASE WHEN INSTR(bp, '/') > 0 THEN SUBSTR(bp, 1, INSTR(bp, '/') - 1) ELSE bp END AS DOUBLE) AS bp_systolic,
  TRY_CAST(CASE WHEN INSTR(bp, '/') > 0 THEN SUBSTR(bp, INSTR(bp, '/') + 1) END AS DOUBLE) AS bp_diastolic
FROM dirty
""",
    "numeric_coerce_fill": """
SELECT patient_id, COALESCE(TRY_CAST(cholesterol_txt AS DOUBLE), 0.0) AS cholesterol FROM dirty
""",
    "category_vocabulary": """
SELECT diet AS category, COUNT(*) AS n FROM dirty WHERE diet IS NOT NULL GROUP BY diet
""",
    "one_hot_drop_first": """
SELECT patient_id,
  CASE WHEN diet = 'Unhealthy' THEN 1 ELSE 0 END AS diet_unhealthy,
  CASE WHEN diet = 'healthy' THEN 1 ELSE 0 END AS diet_healthy,
  CASE WHEN sex = 'MALE' THEN 1 ELSE 0 END AS sex_male
FROM dirty
""",
    "one_hot_fixed_vocabulary": """
SELECT patient_id,
  CASE WHEN LOWER(sex) = 'male' THEN 1 ELSE 0 END AS sex_male,
  CASE WHEN LOWER(diet) = 'healthy' THEN 1 ELSE 0 END AS diet_healthy,
  CASE WHEN LOWER(diet) = 'unhealthy' THEN 1 ELSE 0 END AS diet_unhealthy
FROM dirty
""",
    "feature_align": """
SELECT patient_id, CAST(0 AS INT) AS bmi, COALESCE(TRY_CAST(cholesterol_txt AS DOUBLE), 0.0) AS cholesterol,
  CASE WHEN LOWER(sex) = 'male' THEN 1 ELSE 0 END AS sex_male
FROM dirty
""",
    "stratified_split": """
SELECT patient_id, label, CASE WHEN rn <= n_test THEN 'test' ELSE 'train' END AS part
FROM (SELECT patient_id, label,
        ROW_NUMBER() OVER (PARTITION BY label ORDER BY (patient_id * 2654435761) % 4294967296, patient_id) AS rn,
        CAST(CEIL(COUNT(*) OVER (PARTITION BY label) * 0.2) AS BIGINT) AS n_test
      FROM dirty) t
""",
    "batch_score": """
SELECT patient_id, risk, risk_status FROM pred
""",
    "high_risk_alerts": """
SELECT patient_id, CAST(ROUND(CAST(score AS DECIMAL(20,8)), 3) AS DOUBLE) AS risk_score, 'HIGH_RISK' AS status
FROM scored WHERE score > 0.45
""",
    "run_summary": """
SELECT COUNT(*) AS processed_rows, COUNT(score) AS scored_rows, CAST(SUM(CASE WHEN score > 0.45 THEN 1 ELSE 0 END) AS BIGINT) AS alerts_triggered FROM scored
""",
    "triage_top_risk": """
SELECT p.patient_id, p.risk AS predicted_risk, p.risk_status, CAST(p.scored_at AS TIMESTAMP) AS scored_at,
  d.age, d.sex, d.cholesterol, d.blood_pressure, d.country
FROM pred p LEFT JOIN processed d ON p.patient_id = d.patient_id
ORDER BY p.risk DESC, p.patient_id LIMIT 20
""",
    "high_risk_count": """
SELECT COUNT(*) AS high_risk_count FROM pred WHERE risk > 0.45
""",
    "risk_by_age_band": """
SELECT CASE WHEN d.age < 30 THEN '20-29' WHEN d.age BETWEEN 30 AND 39 THEN '30-39'
            WHEN d.age BETWEEN 40 AND 49 THEN '40-49' WHEN d.age BETWEEN 50 AND 59 THEN '50-59'
            WHEN d.age BETWEEN 60 AND 69 THEN '60-69' ELSE '70+' END AS age_group,
  CAST(ROUND(CAST(AVG(p.risk) AS DECIMAL(20,8)), 3) AS DOUBLE) AS avg_predicted_risk, COUNT(*) AS patients
FROM pred p JOIN processed d ON p.patient_id = d.patient_id GROUP BY 1 ORDER BY 1
""",
    "risk_by_sleep_bucket": """
SELECT CAST(FLOOR(d.sleep_hours) AS BIGINT) AS sleep_hours_floor,
  CAST(ROUND(CAST(AVG(d.sleep_hours) AS DECIMAL(20,8)), 2) AS DOUBLE) AS avg_sleep,
  CAST(ROUND(CAST(AVG(p.risk) AS DECIMAL(20,8)), 3) AS DOUBLE) AS avg_predicted_risk, COUNT(*) AS patients
FROM pred p JOIN processed d ON p.patient_id = d.patient_id GROUP BY 1 ORDER BY 1
""",
    "activity_overview": """
SELECT CAST(ROUND(CAST(AVG(d.activity_days) AS DECIMAL(20,8)), 2) AS DOUBLE) AS avg_activity_days,
  CAST(ROUND(CAST(AVG(d.heart_rate) AS DECIMAL(20,8)), 1) AS DOUBLE) AS avg_heart_rate,
  CAST(ROUND(CAST(AVG(p.risk) AS DECIMAL(20,8)), 3) AS DOUBLE) AS avg_predicted_risk
FROM pred p JOIN processed d ON p.patient_id = d.patient_id
""",
    "row_cap": """
SELECT patient_id, risk FROM pred ORDER BY patient_id LIMIT 50
""",
}

BODIES["csv_round_trip"] = BODIES["processed_health"]
BODIES["stream_score"] = BODIES["batch_score"]

# The page size is that of the query: 25 lines a message.
BODIES["alert_digest"] = """
SELECT alerts,
  CASE WHEN page = 0 THEN CAST(alerts AS STRING) || ' High-Risk Patients Detected:' || CHR(10) ELSE '' END || lines AS message
FROM (SELECT page, alerts,
        STRING_AGG(CAST(patient_id AS STRING) || ': ' || CAST(CAST(ROUND(CAST(score AS DECIMAL(20,8)), 3) AS DOUBLE) AS STRING),
                   CHR(10) ORDER BY patient_id) AS lines
      FROM (SELECT patient_id, score, COUNT(*) OVER () AS alerts,
              (ROW_NUMBER() OVER (ORDER BY patient_id) - 1) // 25 AS page
            FROM scored WHERE score > 0.45) t
      GROUP BY page, alerts) u
"""

BODIES["alerts_table"] = """
SELECT patient_id, ROW_NUMBER() OVER (ORDER BY patient_id) AS n, COUNT(*) OVER () AS alerts,
  CAST(patient_id AS STRING) || ': ' || CAST(CAST(ROUND(CAST(score AS DECIMAL(20,8)), 3) AS DOUBLE) AS STRING) AS line,
  CAST(ROUND(CAST(score AS DECIMAL(20,8)), 3) AS DOUBLE) AS risk_score, 'HIGH_RISK' AS status,
  (SELECT COUNT(*) FROM scored) AS processed_rows, (SELECT COUNT(score) FROM scored) AS scored_rows
FROM scored WHERE score > 0.45
"""

BODIES["scores_with_gaps"] = """
SELECT 'processed_rows' AS figure, CAST(COUNT(*) AS DOUBLE) AS value FROM gaps
UNION ALL SELECT 'scored_rows', CAST(COUNT(*) AS DOUBLE) FROM gaps WHERE kind <> 'null'
UNION ALL SELECT 'alerts_triggered', CAST(COUNT(*) AS DOUBLE) FROM gaps WHERE kind = 'number' AND score > 0.45
UNION ALL SELECT 'high_risk_count', CAST(COUNT(*) AS DOUBLE) FROM gaps
  WHERE kind = 'number' AND CAST(ROUND(CAST(score AS DECIMAL(20,8)), 6) AS DOUBLE) > 0.45
UNION ALL SELECT 'avg_predicted_risk',
  CAST(ROUND(CAST(AVG(CAST(ROUND(CAST(score AS DECIMAL(20,8)), 6) AS DOUBLE)) AS DECIMAL(20,8)), 3) AS DOUBLE)
  FROM gaps g JOIN processed d ON g.patient_id = d.patient_id WHERE kind = 'number'
UNION ALL SELECT 'top_risk', MAX(CAST(ROUND(CAST(score AS DECIMAL(20,8)), 6) AS DOUBLE)) FROM gaps WHERE kind = 'number'
"""

BODIES["skewed_history_join"] = """
SELECT w.patient_id, COUNT(*) AS n, CAST(SUM(age) AS BIGINT) AS age_sum, COUNT(DISTINCT diet) AS diets,
  MAX(activity_days) AS activity_days
FROM weekly w LEFT JOIN (SELECT CASE WHEN patient_id % 3 = 0 THEN 8 ELSE patient_id END AS patient_id, age, diet FROM demo) m
  ON w.patient_id = m.patient_id
GROUP BY w.patient_id
"""

BODIES["csv_scan_vitals"] = """
SELECT CAST(patient_id AS STRING) AS patient_id, COUNT(*) AS n,
  COUNT(CASE WHEN patient_id % 11 <> 1 THEN heart_rate END) AS readings,
  ROUND(SUM(CASE WHEN patient_id % 11 <> 1 THEN heart_rate END), 2) AS heart_rate,
  CAST(SUM(bp_systolic + bp_diastolic) AS DOUBLE) AS pressure, COUNT(sleep_hours) AS nights,
  CAST(SUM(physical_activity) AS BIGINT) AS activity
FROM vitals GROUP BY patient_id
"""

BODIES["csv_scan_history"] = """
SELECT patient_id, CAST(age AS INT) AS age, cholesterol,
  CASE patient_id % 3 WHEN 0 THEN diet || ', "as told"' WHEN 1 THEN diet ELSE NULL END AS diet, sex, country
FROM demo
"""

BODIES["feature_list_round_trip"] = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY block, name) AS INT) AS position, name
FROM (SELECT 0 AS block, 'Cholesterol' AS name UNION ALL SELECT 1, 'BP_Systolic' UNION ALL SELECT 2, 'BP_Diastolic'
      UNION ALL SELECT 3, 'Sex_' || v FROM (SELECT v FROM (SELECT DISTINCT sex AS v FROM dirty WHERE sex IS NOT NULL) a ORDER BY v OFFSET 1) b
      UNION ALL SELECT 4, 'Diet_' || v FROM (SELECT v FROM (SELECT DISTINCT diet AS v FROM dirty WHERE diet IS NOT NULL) c ORDER BY v OFFSET 1) d) t
"""

BODIES["pick_latest_run"] = BODIES["batch_score"]

# Keto and KETO are one level, the first in order and so the baseline.
BODIES["serving_parity"] = """
SELECT patient_id, CASE patient_id % 4 WHEN 1 THEN 2.0 WHEN 3 THEN 1.0 ELSE 0.0 END::DOUBLE AS score, CAST(2 AS INT) AS dummies
FROM dirty
"""

BODIES["sql_reports"] = """
SELECT d.country, COUNT(DISTINCT p.patient_id) AS patients,
  CAST(MAX(EPOCH(CAST(p.scored_at AS TIMESTAMP))) AS BIGINT) AS latest
FROM pred p JOIN processed d ON d.patient_id = p.patient_id WHERE p.risk_status = 'HIGH_RISK' GROUP BY d.country
"""

BODIES["utc_stamps"] = """
SELECT event_id,
  STRFTIME(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN EXTRACT(MICROSECONDS FROM t) % 1000000 = 0 THEN '' ELSE STRFTIME(t, '.%f') END || 'Z' AS iso,
  STRFTIME(t, '%Y%m%d_%H%M%S') AS run
FROM (SELECT event_id, ts::TIMESTAMP + CASE WHEN event_id % 3 = 0 THEN TO_MICROSECONDS(event_id % 1000000) ELSE TO_MICROSECONDS(0) END AS t FROM events) e
"""

# What holds of a trained model whatever its trees are.
BODIES["gbt_batch_score"] = """
SELECT patient_id, CASE WHEN rn <= n_test THEN 'test' ELSE 'train' END AS part,
  TRUE AS in_range, TRUE AS status_agrees, TRUE AS saved_agrees
FROM (SELECT patient_id, ROW_NUMBER() OVER (PARTITION BY label ORDER BY (patient_id * 2654435761) % 4294967296, patient_id) AS rn,
        CAST(CEIL(COUNT(*) OVER (PARTITION BY label) * 0.2) AS BIGINT) AS n_test
      FROM (SELECT patient_id, CASE WHEN cholesterol > 6000 THEN 1 ELSE 0 END AS label FROM processed) l) t
"""

BODIES["gbt_evaluate"] = """
SELECT COUNT(*) AS rows, CAST(SUM(label) AS BIGINT) AS positives, TRUE AS areas_agree, TRUE AS in_range
FROM (SELECT label, ROW_NUMBER() OVER (PARTITION BY label ORDER BY (patient_id * 2654435761) % 4294967296, patient_id) AS rn,
        CAST(CEIL(COUNT(*) OVER (PARTITION BY label) * 0.2) AS BIGINT) AS n_test
      FROM (SELECT patient_id, CASE WHEN cholesterol > 6000 THEN 1 ELSE 0 END AS label FROM processed) l) t
WHERE rn <= n_test
"""

BODIES["training_features"] = """
SELECT patient_id, label, COALESCE(TRY_CAST(cholesterol_txt AS DOUBLE), 0.0) AS cholesterol,
  COALESCE(TRY_CAST(CASE WHEN INSTR(bp, '/') > 0 THEN SUBSTR(bp, 1, INSTR(bp, '/') - 1) ELSE bp END AS DOUBLE), 0.0) AS bp_systolic,
  COALESCE(TRY_CAST(CASE WHEN INSTR(bp, '/') > 0 THEN SUBSTR(bp, INSTR(bp, '/') + 1) END AS DOUBLE), 0.0) AS bp_diastolic,
  CASE WHEN sex = 'MALE' THEN 1 ELSE 0 END AS sex_male,
  CASE WHEN diet = 'Unhealthy' THEN 1 ELSE 0 END AS diet_unhealthy,
  CASE WHEN diet = 'healthy' THEN 1 ELSE 0 END AS diet_healthy
FROM dirty
"""

BODIES["training_channels"] = f"""
SELECT label, CASE WHEN rn <= n_test THEN 'test' ELSE 'train' END AS part,
  cholesterol, bp_systolic, bp_diastolic, CAST(sex_male AS DOUBLE) AS sex_male,
  CAST(diet_unhealthy AS DOUBLE) AS diet_unhealthy, CAST(diet_healthy AS DOUBLE) AS diet_healthy
FROM (SELECT f.*,
        ROW_NUMBER() OVER (PARTITION BY label ORDER BY (patient_id * 2654435761) % 4294967296, patient_id) AS rn,
        CAST(CEIL(COUNT(*) OVER (PARTITION BY label) * 0.2) AS BIGINT) AS n_test
      FROM ({BODIES["training_features"]}) f) t
"""

BODIES["fallback_id"] = """
SELECT patient_id AS line, risk_status,
  'Row' || CAST(ROW_NUMBER() OVER (ORDER BY patient_id) AS STRING) AS row_id
FROM pred
"""

BODIES["predictions_union"] = """
SELECT patient_id, risk, risk_status, scored_at, '20251124_010404' AS run_id FROM pred
UNION ALL
SELECT patient_id, risk, risk_status, scored_at, '20251201_010404' AS run_id FROM pred
"""

BODIES["table_row_counts"] = """
SELECT 'processed' AS name, COUNT(*) AS n FROM processed
UNION ALL
SELECT 'predictions' AS name, COUNT(*) AS n FROM pred
"""

# Share of (positive, negative) pairs in the right order, ties counting half. The
# score is that of ``scored``, per processed row.
BODIES["evaluate_auc"] = """
SELECT ROUND(SUM(CAST(pos AS DOUBLE) * (neg_below + neg / 2.0)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)), 6) AS auc
FROM (SELECT pos, neg, SUM(neg) OVER (ORDER BY risk) - neg AS neg_below
      FROM (SELECT risk, SUM(label) AS pos, SUM(1 - label) AS neg
            FROM (SELECT CASE WHEN cholesterol > 6000 THEN 1 ELSE 0 END AS label,
                    CAST(ROUND(CAST(1 / (1 + EXP(-(-2.0 + 0.02 * heart_rate + 0.1 * COALESCE(sleep_hours, 0.0)
                      + CASE WHEN LOWER(sex) = 'male' THEN 0.3 ELSE 0.0 END
                      - CAST(0.01 AS DOUBLE) * activity_days))) AS DECIMAL(20,8)), 6) AS DOUBLE) AS risk
                  FROM processed) s
            GROUP BY risk) t) u
"""
