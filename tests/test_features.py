import pytest

from vitalgrid import config as C
from vitalgrid.operators import features as ft
from vitalgrid.sources import schemas as S

COLUMNS = (
    "`Patient ID` string, `Heart Rate` double, `Blood Pressure` string, Age int, Sex string, "
    "Diet string, Country string, `Heart Attack Risk` int"
)
ROWS = [
    ("a", 60.0, "120/80", 40, "Male", "Healthy", "X", 1),
    ("b", float("nan"), "abc/80", None, "Female", "Average", "Y", 0),
    ("c", None, None, 30, None, "Unhealthy", "Y", None),
    ("d", 70.0, "118", 20, "MALE", "healthy", "Z", 0),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


@pytest.fixture
def case_sensitive(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    yield
    spark.conf.set("spark.sql.caseSensitive", "false")


def test_levels_are_sorted_and_the_first_is_dropped(rows, case_sensitive):
    encoder = ft.fit_encoder(rows)
    assert encoder.levels == (
        ("Sex", "MALE"), ("Sex", "Male"),
        ("Diet", "Healthy"), ("Diet", "Unhealthy"), ("Diet", "healthy"),
    )


def test_levels_differing_by_case(rows):
    with pytest.raises(ValueError, match="caseSensitive"):
        ft.fit_encoder(rows)
    encoder = ft.fit_encoder(rows, ignore_case=True)
    assert encoder.levels == (("Sex", "MALE"), ("Diet", "Healthy"), ("Diet", "Unhealthy"))
    table = ft.feature_table(rows, encoder, keep=("Patient ID",))
    assert {r[0]: r["Sex_MALE"] for r in table.collect()} == {"a": 1, "b": 0, "c": 0, "d": 1}


def test_too_many_levels_fail(spark):
    df = spark.range(50).selectExpr("cast(id as string) c", "'x' d")
    with pytest.raises(ValueError, match="50 levels in column 'c', more than 10"):
        ft.fit_encoder(df, ("d", "c"), max_levels=10)
    assert len(ft.fit_encoder(df, ("d", "c")).levels) == 49
    assert len(ft.fit_encoder(df, ("d", "c"), max_levels=50).levels) == 49


def test_training_table(rows, case_sensitive):
    table = ft.training_table(rows, ft.fit_encoder(rows), keep=("Patient ID",))
    assert table.columns == [
        "Patient ID", "Heart Attack Risk", "Heart Rate", "Age", "BP_Systolic", "BP_Diastolic",
        "Sex_MALE", "Sex_Male", "Diet_Healthy", "Diet_Unhealthy", "Diet_healthy",
    ]
    got = {r[0]: tuple(r)[1:] for r in table.collect()}
    assert got["a"] == (1, 60.0, 40, 120.0, 80.0, 0, 1, 1, 0, 0)
    assert got["b"] == (0, 0.0, 0, 0.0, 80.0, 0, 0, 0, 0, 0)
    assert got["c"] == (0, 0.0, 30, 0.0, 0.0, 0, 0, 0, 1, 0)
    assert got["d"] == (0, 70.0, 20, 118.0, 0.0, 1, 0, 0, 0, 1)


def test_each_row_has_at_most_one_level(rows, case_sensitive):
    encoder = ft.fit_encoder(rows)
    for r in ft.feature_table(rows, encoder).collect():
        for column in C.CATEGORICAL_COLUMNS:
            assert sum(r[f"{c}_{v}"] for c, v in encoder.levels if c == column) <= 1


def test_serving_ignores_case_and_aligns(rows):
    expected = ["Sex_Male", "BMI", "Heart Rate", "Diet_Healthy", "BP_Diastolic"]
    table = ft.serving_table(rows, expected, keep=("Patient ID",))
    assert table.columns == ["Patient ID", *expected]
    got = {r[0]: tuple(r)[1:] for r in table.collect()}
    assert got["a"] == (1, 0, 60.0, 1, 80.0)
    assert got["d"] == (1, 0, 70.0, 1, 0.0)
    assert got["c"] == (0, 0, 0.0, 0, 0.0)


def test_serving_coerces_text(spark):
    df = spark.createDataFrame(
        [("a", "oops", "Male", "x"), ("b", "", "f", None), ("c", None, None, "y"), ("d", "7", "m", "")],
        "`Patient ID` string, Cholesterol string, Sex string, Diet string",
    )
    got = ft.serving_table(df, ["Cholesterol"]).collect()
    assert [r[0] for r in got] == [0.0, 0.0, 0.0, 7.0]


def test_serving_uses_the_fitted_levels(rows):
    keto = rows.replace({"Healthy": "Keto", "healthy": "KETO"}, subset=["Diet"])
    encoder = ft.fit_encoder(keto, ("Diet",), ignore_case=True)
    assert ft.Encoder.from_json(encoder.to_json()) == encoder
    expected = [f"Diet_{v}" for _, v in encoder.levels]
    trained = ft.feature_table(keto, encoder, keep=("Patient ID",)).select("Patient ID", *expected)
    served = ft.serving_table(keto, expected, encoder, keep=("Patient ID",))
    assert sorted(map(tuple, served.collect())) == sorted(map(tuple, trained.collect()))
    with pytest.raises(ValueError, match="Diet_Keto"):
        ft.serving_table(keto, ["Diet_Keto"])


def test_serving_needs_its_categories(rows):
    with pytest.raises(ValueError, match="Diet"):
        ft.serving_table(rows.drop("Diet"), ["Diet_Healthy"])


def test_default_features(spark):
    """18 numbers in source order, both pressures, three dummies."""
    df = spark.createDataFrame([], S.file_schema(S.PROCESSED))
    names = ft.feature_table(df, ft.SERVING).columns
    assert len(names) == 23
    assert names[:3] == ["Heart Rate", "Sleep Hours Per Day", "Physical Activity Days Per Week"]
    assert names[18:] == [
        "BP_Systolic", "BP_Diastolic", "Sex_Male", "Diet_Healthy", "Diet_Unhealthy",
    ]
