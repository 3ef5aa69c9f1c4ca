"""Table schemas: file column name, internal name and type."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Columns of each table, as (file name, internal name, type).
VITALS = (
    ("Patient ID", "patient_id", "string"),
    ("Heart Rate", "heart_rate", "double"),
    ("BP_Systolic", "bp_systolic", "double"),
    ("BP_Diastolic", "bp_diastolic", "double"),
    ("Sleep Hours Per Day", "sleep_hours", "double"),
    ("Physical Activity Per day", "physical_activity", "int"),
    ("Timestamp", "timestamp", "bigint"),
)

PROCESSED = (
    ("Patient ID", "patient_id", "string"),
    ("Heart Rate", "heart_rate", "double"),
    ("Sleep Hours Per Day", "sleep_hours", "double"),
    ("Physical Activity Days Per Week", "activity_days", "bigint"),
    ("Blood Pressure", "blood_pressure", "string"),
    ("Age", "age", "int"),
    ("Sex", "sex", "string"),
    ("Cholesterol", "cholesterol", "double"),
    ("Diabetes", "diabetes", "int"),
    ("Family History", "family_history", "int"),
    ("Smoking", "smoking", "int"),
    ("Obesity", "obesity", "int"),
    ("Alcohol Consumption", "alcohol_consumption", "double"),
    ("Exercise Hours Per Week", "exercise_hours", "double"),
    ("Diet", "diet", "string"),
    ("Previous Heart Problems", "previous_heart_problems", "int"),
    ("Medication Use", "medication_use", "int"),
    ("Stress Level", "stress_level", "int"),
    ("Sedentary Hours Per Day", "sedentary_hours", "double"),
    ("Income", "income", "bigint"),
    ("BMI", "bmi", "double"),
    ("Triglycerides", "triglycerides", "int"),
    ("Country", "country", "string"),
    ("Continent", "continent", "string"),
    ("Hemisphere", "hemisphere", "string"),
)

TARGET = ("Heart Attack Risk", "heart_attack_risk", "int")

# History holds the processed columns (older vitals among them) and the target.
HISTORY = PROCESSED + (TARGET,)

PREDICTIONS = (
    ("Patient ID", "patient_id", "string"),
    ("Heart Attack Risk", "risk", "double"),
    ("Risk_Status", "risk_status", "string"),
    ("ScoredAt", "scored_at", "string"),
)

Table = tuple[tuple[str, str, str], ...]


def file_schema(table: Table) -> T.StructType:
    """Schema with file column names."""
    return T.StructType.fromDDL(", ".join(f"`{f}` {t}" for f, _, t in table))


def internal_schema(table: Table) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for _, n, t in table))


def table_of(df: DataFrame, table: Table = PROCESSED) -> Table:
    """The part of ``table`` that ``df`` holds, in the order and types of ``df``."""
    names = {n: f for f, n, _ in table}
    return tuple((names.get(f.name, f.name), f.name, f.dataType.simpleString()) for f in df.schema)


def to_file_names(df: DataFrame, table: Table) -> DataFrame:
    return df.withColumnsRenamed({n: f for f, n, _ in table})


def to_internal_names(df: DataFrame, table: Table) -> DataFrame:
    return df.withColumnsRenamed({f: n for f, n, _ in table})


def typed(df: DataFrame, table: Table) -> DataFrame:
    """Text columns to the declared types, by name; a column the file lacks is
    left out, one the table does not declare is kept as text."""
    from vitalgrid.functions import to_bigint, to_number

    kinds = {f: t for f, _, t in table}

    def cast(name: str):
        c, kind = F.col(f"`{name}`"), kinds.get(name, "string")
        if kind == "string":
            return c
        number = to_number(c) if kind == "double" else to_bigint(c).try_cast(kind)
        return number.alias(name)

    return df.select([cast(c) for c in df.columns])
