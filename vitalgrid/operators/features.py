"""Numeric feature table. One encoder serves training and scoring."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid import config as C
from vitalgrid.functions import bp_diastolic, bp_systolic, fill_number, to_number

Levels = tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Encoder:
    """Dummy columns, as (column, level), and how levels are compared."""

    levels: Levels
    ignore_case: bool = False

    def dummy(self, column: str, level: str) -> Column:
        value, wanted = F.col(f"`{column}`"), level
        if self.ignore_case:
            value, wanted = F.lower(value), level.lower()
        return F.when(value == wanted, 1).otherwise(0).alias(f"{column}_{level}")

    def dummies(self) -> list[Column]:
        return [self.dummy(c, v) for c, v in self.levels]

    def to_json(self) -> str:
        return json.dumps({"levels": self.levels, "ignore_case": self.ignore_case})

    @staticmethod
    def from_json(text: str) -> Encoder:
        stored = json.loads(text)
        return Encoder(tuple((c, v) for c, v in stored["levels"]), stored["ignore_case"])


# The fixed levels of the serving side, compared without regard to case.
SERVING = Encoder(C.SERVING_LEVELS, ignore_case=True)


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL levels of a column with their row counts."""
    level = F.col(f"`{column}`").alias("category")
    return df.where(F.col(f"`{column}`").isNotNull()).groupBy(level).agg(F.count("*").alias("n"))


def fit_encoder(
    df: DataFrame,
    columns: tuple[str, ...] = C.CATEGORICAL_COLUMNS,
    max_levels: int | None = None,
    ignore_case: bool = False,
) -> Encoder:
    """Learn the levels of each column; the first in sorted order is the baseline
    and gets no dummy. Every level is a column of the result, and so reaches the
    driver; a caller may name a limit, over which a column is an error.

    Levels that differ only by case are levels of their own, unless ``ignore_case``
    makes them one. They need a session with case-sensitive column names.
    """
    pairs = F.explode(
        F.array([F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v"))
                 for i, c in enumerate(columns)])
    )
    found = df.select(pairs.alias("p")).select("p.*").where("v IS NOT NULL").distinct()
    if max_levels is not None:
        over = found.groupBy("i").count().where(F.col("count") > max_levels).orderBy("i").first()
        if over:
            raise ValueError(f"{over['count']} levels in column {columns[over.i]!r}, more than {max_levels}")
    rows = found.collect()
    levels: list[tuple[str, str]] = []
    for i, column in enumerate(columns):
        values = sorted(r.v for r in rows if r.i == i)
        if ignore_case:
            firsts: dict[str, str] = {}
            for v in values:
                firsts.setdefault(v.lower(), v)
            values = list(firsts.values())
        levels += [(column, v) for v in values[1:]]
    names = [f"{c}_{v}".lower() for c, v in levels]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice and df.sparkSession.conf.get("spark.sql.caseSensitive") == "false":
        raise ValueError(
            f"levels differ only by case ({twice}): set spark.sql.caseSensitive=true, "
            "or fit with ignore_case=True"
        )
    return Encoder(tuple(levels), ignore_case)


def split_blood_pressure(df: DataFrame, column: str = C.BLOOD_PRESSURE_COLUMN) -> DataFrame:
    """Both readings as numbers at the end, in place of the text."""
    if column not in df.columns:
        return df
    bp = F.col(f"`{column}`")
    return df.withColumns(
        {C.BP_SYSTOLIC: bp_systolic(bp), C.BP_DIASTOLIC: bp_diastolic(bp)}
    ).drop(column)


def _number(df: DataFrame, column: str) -> Column:
    c = F.col(f"`{column}`")
    kind = df.schema[column].dataType.simpleString()
    if kind == "string":
        return fill_number(to_number(c)).alias(column)
    if kind in ("double", "float"):
        return fill_number(c).alias(column)
    return F.coalesce(c.cast("int") if kind == "boolean" else c, F.lit(0)).alias(column)


def feature_table(df: DataFrame, encoder: Encoder, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numeric columns in source order, blood pressure, then dummies; NULL becomes 0.

    ``keep`` names columns passed through in front, such as the id for scoring.
    A categorical column the encoder needs must be there.
    """
    categorical = tuple(dict.fromkeys(c for c, _ in encoder.levels)) or C.CATEGORICAL_COLUMNS
    missing = [c for c in categorical if c not in df.columns and encoder.levels]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    split = split_blood_pressure(df)
    left_out = {*C.IDENTIFIER_COLUMNS, *C.CATEGORICAL_COLUMNS, *categorical, *keep}
    numbers = [_number(split, c) for c in split.columns if c not in left_out]
    kept = [F.col(f"`{c}`") for c in keep]
    return split.select(*kept, *numbers, *encoder.dummies())


def align(df: DataFrame, expected: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the expected features in their order; absent ones are 0."""
    have = set(df.columns)
    columns = [F.col(f"`{f}`") if f in have else F.lit(0).alias(f) for f in expected]
    return df.select(*[F.col(f"`{c}`") for c in keep], *columns)


def training_table(
    df: DataFrame, encoder: Encoder, target: str = C.TARGET_COLUMN, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Target first as an integer (a missing one counts as 0), then the features."""
    table = feature_table(df, encoder, keep)
    rest = [F.col(f"`{c}`") for c in table.columns if c != target and c not in keep]
    kept = [F.col(f"`{c}`") for c in keep]
    return table.select(*kept, F.col(f"`{target}`").cast("int").alias(target), *rest)


def serving_table(
    df: DataFrame, expected: list[str], encoder: Encoder = SERVING, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Features for scoring, in the order the model was trained with.

    ``encoder`` is the fitted one, or the fixed levels. An expected dummy that comes
    from none of its levels is an error: filled with 0 it would change every score.
    """
    known = {f"{c}_{v}" for c, v in encoder.levels}
    categorical = {*C.CATEGORICAL_COLUMNS, *(c for c, _ in encoder.levels)}
    unknown = [f for f in expected if f not in known and any(f.startswith(f"{c}_") for c in categorical)]
    if unknown:
        raise ValueError(f"features of levels that the encoder does not know: {unknown}")
    return align(feature_table(df, encoder, keep), expected, keep)
