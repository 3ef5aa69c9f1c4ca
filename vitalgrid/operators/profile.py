"""A profile of every column in one scan, from sketches that tasks merge.

| figure | sketch | bound |
| --- | --- | --- |
| distinct values | HyperLogLog++ | relative standard deviation ``DEVIATION`` |
| quantiles | Greenwald-Khanna | rank off by ``1 / ACCURACY`` of the rows at most |
| frequent values | ``TRACKED`` counters | count off by ``FREQUENT_BOUND`` of the rows at most |

Where no value is surely more frequent than that bound, none is listed.

Rows, missing values, least and greatest are exact. Sketches have a bounded size, so the
scan moves a few KB per column and task whatever the table holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from vitalgrid.session import staged

DEVIATION = 0.02
ACCURACY = 1000
TRACKED = 4096
FREQUENT_BOUND = 4 / TRACKED
FREQUENT = 3
QUANTILES = (0.25, 0.5, 0.75)
SCHEMA = (
    "column string, rows bigint, missing bigint, distinct bigint, least string, greatest string, "
    "quantiles array<double>, frequent array<struct<value string, count bigint>>"
)


def profile(df: DataFrame) -> DataFrame:
    """One row per column, see ``SCHEMA``. Quantiles are NULL for text."""
    figures = []
    for i, f in enumerate(df.schema):
        c = F.col(f"`{f.name}`")
        text = c.cast("string")
        is_number = isinstance(f.dataType, T.NumericType)
        figures += [
            F.count(c).alias(f"n{i}"),
            F.approx_count_distinct(c, DEVIATION).alias(f"d{i}"),
            F.min(c).cast("string").alias(f"lo{i}"),
            F.max(c).cast("string").alias(f"hi{i}"),
            (F.percentile_approx(c.cast("double"), list(QUANTILES), ACCURACY) if is_number else F.first(F.lit(None).cast("array<double>"))).alias(f"q{i}"),
            F.expr(f"approx_top_k(CAST(`{f.name}` AS STRING), {FREQUENT}, {TRACKED})").alias(f"k{i}"),
        ]
    one = staged(df.agg(F.count("*").alias("rows"), *figures), "profile")
    rows = [
        one.select(
            F.lit(f.name).alias("column"), "rows", (F.col("rows") - F.col(f"n{i}")).alias("missing"), F.col(f"d{i}").alias("distinct"),
            F.col(f"lo{i}").alias("least"), F.col(f"hi{i}").alias("greatest"), F.col(f"q{i}").alias("quantiles"),
            F.transform(F.filter(f"k{i}", lambda x: x.item.isNotNull()), lambda x: F.struct(x.item.alias("value"), x["count"].alias("count"))).alias("frequent"),
        )
        for i, f in enumerate(df.schema)
    ]
    return reduce(DataFrame.unionByName, rows)
