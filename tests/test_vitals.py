from collections import Counter

from vitalgrid.operators.joins import hot_keys, left_join
from vitalgrid.operators.vitals import processed_health, weekly_vitals

VITALS = (
    "patient_id string, heart_rate double, bp_systolic double, bp_diastolic double, "
    "sleep_hours double, physical_activity int"
)


def vitals(spark, rows):
    return spark.createDataFrame(rows, VITALS)


def test_weekly_averages(spark):
    got = weekly_vitals(
        vitals(
            spark,
            [
                ("a", 60.0, 120.0, 80.0, 7.0, 1),
                ("a", 61.0, 121.0, None, 7.25, 1),
                ("b", None, None, None, None, None),
            ],
        )
    )
    rows = {r.patient_id: tuple(r)[1:] for r in got.collect()}
    assert rows["a"] == (61.0, 121, 80, 7.13, 2)
    assert rows["b"] == (None, None, None, None, None)


def test_processed_keeps_vitals_and_fans_out(spark):
    v = vitals(
        spark,
        [
            ("a", 60.0, 120.0, 80.0, 7.0, 1),
            ("b", 70.0, None, 90.0, 6.0, 0),
            ("c", 80.0, None, None, 5.0, 0),
        ],
    )
    h = spark.createDataFrame(
        [("a", 40, 99.0, 1), ("b", 50, 98.0, 0), ("b", 51, 97.0, 0), ("z", 60, 96.0, 1)],
        "patient_id string, age int, heart_rate double, heart_attack_risk int",
    )
    got = processed_health(v, h)
    assert got.columns == [
        "patient_id", "heart_rate", "sleep_hours", "activity_days", "blood_pressure", "age",
    ]
    assert sorted(map(tuple, got.collect()), key=repr) == [
        ("a", 60.0, 7.0, 1, "120/80", 40),
        ("b", 70.0, 6.0, 0, "90", 50),
        ("b", 70.0, 6.0, 0, "90", 51),
        ("c", 80.0, 5.0, 0, "", None),
    ]


def skewed(spark):
    left = spark.createDataFrame([(i, f"l{i}") for i in range(20)] + [(None, "n")], "k int, l string")
    rows = [(7, i) for i in range(500)] + [(i % 30, 1000 + i) for i in range(1000)] + [(None, 1)]
    return left, spark.createDataFrame(rows, "k int, r int").repartition(6)


def test_hot_keys_are_counted(spark):
    _, right = skewed(spark)
    assert [tuple(r) for r in hot_keys(right, "k", 100).collect()] == [(7, 6)]
    assert hot_keys(right, "k").count() == 0


def test_salted_join_equals_plain_join(spark):
    left, right = skewed(spark)
    want = Counter(map(tuple, left.join(right, "k", "left").collect()))
    for rows_per_salt in (1, 7, 33, 300, 100_000):
        got = left_join(left, right, "k", rows_per_salt)
        assert got.columns == ["k", "l", "r"]
        assert Counter(map(tuple, got.collect())) == want


def test_salted_join_spreads_the_hot_key(spark):
    from pyspark.sql import functions as F

    left, right = skewed(spark)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def tasks(df):
            return df.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()

        assert tasks(left.join(right, "k", "left")) == 1
        assert tasks(left_join(left, right, "k", 50)) > 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
