import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vitalgrid import functions as fn


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit(v, kind):
    return F.lit(v).cast(kind)


@pytest.mark.parametrize(
    "x, digits, want",
    [
        (2.5, 0, 3.0),
        (-2.5, 0, -3.0),
        (2.675, 2, 2.68),
        (0.1 + 0.2 - 0.2995, 3, 0.001),
        (1e15 + 0.5, 0, 1e15 + 1),
        (None, 2, None),
    ],
)
def test_round_stable(spark, x, digits, want):
    assert value(spark, fn.round_stable(lit(x, "double"), digits)) == want


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 6])
def test_round_stable_equals_the_decimal(spark, digits):
    """Random values, exact ties, and values a few last bits around ties."""
    rng = random.Random(digits)
    xs = [rng.uniform(-1e3, 1e3) for _ in range(3000)] + [rng.uniform(-1e9, 1e9) for _ in range(500)]
    for _ in range(3000):
        tie = (rng.randint(-(10**5), 10**5) + 0.5) / 10**digits
        shift = rng.choice([0.0, 1e-15, -1e-15, 1e-11, -1e-11, 4e-9, -4e-9, 6e-9, -6e-9, 1e-7, -1e-7])
        xs.append(tie + shift)
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    want = F.expr(f"CAST(ROUND(CAST(x AS DECIMAL(20,8)), {digits}) AS DOUBLE)")
    got = df.select("x", fn.round_stable(F.col("x"), digits).alias("got"), want.alias("want"))
    assert got.where("got <> want").take(3) == []


def test_round_stable_keeps_nan(spark):
    got = value(spark, fn.round_stable(lit("NaN", "double"), 2))
    assert got != got


@pytest.mark.parametrize(
    "text, want",
    [
        ("12", 12.0),
        (" 12.5 ", 12.5),
        ("-.5", -0.5),
        ("5.", 5.0),
        ("1e3", 1000.0),
        ("1d", None),
        ("1f", None),
        ("0x1p3", None),
        ("oops", None),
        ("", None),
        ("1 2", None),
        (None, None),
        ("inf", float("inf")),
    ],
)
def test_to_number(spark, text, want):
    assert value(spark, fn.to_number(lit(text, "string"))) == want


@pytest.mark.parametrize(
    "text, want",
    [("9007199254740993", 9007199254740993), ("45.0", 45), ("oops", None), (None, None)],
)
def test_to_bigint(spark, text, want):
    assert value(spark, fn.to_bigint(lit(text, "string"))) == want


@pytest.mark.parametrize("x, want", [(None, 0.0), ("NaN", 0.0), ("1.5", 1.5)])
def test_fill_number(spark, x, want):
    assert value(spark, fn.fill_number(lit(x, "double"))) == want


@pytest.mark.parametrize(
    "systolic, diastolic, want",
    [(120, 80, "120/80"), (None, 80, "80"), (120, None, "120"), (None, None, "")],
)
def test_bp_text(spark, systolic, diastolic, want):
    assert value(spark, fn.bp_text(lit(systolic, "int"), lit(diastolic, "int"))) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("120/80", (120.0, 80.0)),
        ("120/80/x", (120.0, None)),
        ("120", (120.0, None)),
        ("abc/80", (None, 80.0)),
        (" 118 / 77 ", (118.0, 77.0)),
        ("", (None, None)),
        (None, (None, None)),
    ],
)
def test_bp_parts(spark, text, want):
    bp = lit(text, "string")
    assert tuple(value(spark, F.struct(fn.bp_systolic(bp), fn.bp_diastolic(bp)))) == want


@pytest.mark.parametrize(
    "score, want",
    [
        (0.45, "LOW_RISK"),
        (0.4500000001, "HIGH_RISK"),
        (0.9, "HIGH_RISK"),
        ("NaN", "LOW_RISK"),
    ],
)
def test_risk_status(spark, score, want):
    assert value(spark, fn.risk_status(lit(score, "double"))) == want


@pytest.mark.parametrize(
    "age, want",
    [
        (12, "20-29"),
        (29, "20-29"),
        (30, "30-39"),
        (39, "30-39"),
        (40, "40-49"),
        (59, "50-59"),
        (69, "60-69"),
        (70, "70+"),
        (None, "70+"),
    ],
)
def test_age_band(spark, age, want):
    assert value(spark, fn.age_band(lit(age, "int"))) == want


def test_times_are_utc_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        second = F.timestamp_seconds(F.lit(1763946244))
        micros = F.timestamp_micros(F.lit(1763946244000001))
        assert value(spark, fn.iso_utc(second)) == "2025-11-24T01:04:04Z"
        assert value(spark, fn.iso_utc(micros)) == "2025-11-24T01:04:04.000001Z"
        assert value(spark, fn.run_stamp(second)) == "20251124_010404"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_parse_iso(spark):
    micros = F.unix_micros(fn.parse_iso(F.lit("2025-11-24T01:04:04.5Z")))
    assert value(spark, micros) == 1763946244500000
    assert value(spark, fn.parse_iso(F.lit("zzz"))) is None
    assert isinstance(value(spark, fn.parse_iso(F.lit("2025-11-24T01:04:04Z"))), dt.datetime)


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin", "Australia/Lord_Howe"])
def test_stamps_across_clock_changes(spark, zone):
    """Every half hour of the days around both changes keeps its UTC wall clock."""
    from datetime import datetime, timedelta, timezone

    from vitalgrid.functions import iso_utc, run_stamp

    starts = [datetime(2025, m, d, tzinfo=timezone.utc) for m, d in ((3, 9), (3, 30), (4, 5), (10, 4), (10, 26), (11, 2))]
    times = [s + timedelta(minutes=30 * i) for s in starts for i in range(60)] + [datetime(1969, 12, 31, 23, 59, 59, 250000, timezone.utc)]
    keep = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(i, int(t.timestamp() // 1) * 10**6 + t.microsecond) for i, t in enumerate(times)]
        ts = F.timestamp_micros("us")
        got = spark.createDataFrame(rows, "i int, us bigint").select("i", iso_utc(ts).alias("iso"), run_stamp(ts).alias("run")).collect()
        for r in got:
            t = times[r.i]
            fraction = f".{t.microsecond:06d}" if t.microsecond else ""
            assert r.iso == t.strftime("%Y-%m-%dT%H:%M:%S") + fraction + "Z"
            assert r.run == t.strftime("%Y%m%d_%H%M%S")
    finally:
        spark.conf.set("spark.sql.session.timeZone", keep)
