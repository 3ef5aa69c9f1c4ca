"""Ranks with ties over a whole table, without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid.operators.numbering import number_rows


def ranked_groups(df: DataFrame, column: str, *sums: Column) -> DataFrame:
    """One row per distinct non-NULL value of ``column``: ``n`` rows, their
    ``mean_rank`` from 1 up (ties share the mean of their places), and ``sums``.

    All rows are numbered over range partitions; of a value the least and the greatest
    number tell its mean. A value that many rows share spreads, and combines before the
    shuffle."""
    numbered = number_rows(df.where(F.col(column).isNotNull()), [column], "_n")
    middle = (F.min("_n") + F.max("_n")) / 2
    return numbered.groupBy(column).agg(F.count("*").alias("n"), middle.alias("mean_rank"), *sums)


def rank_area(scored: DataFrame, target: str, column: str = "score") -> DataFrame:
    """``auc``, ``rows``, ``positives`` in one row: the share of (positive, negative)
    pairs in the right order, ties counting half, from the ranks of the positives.
    NULL where there is no such pair. Rows without a score are left out."""
    rows = scored.select(F.col(f"`{column}`").alias("_score"), F.col(f"`{target}`").cast("double").alias("_y"))
    groups = ranked_groups(rows, "_score", F.sum("_y").alias("positives"))
    sums = groups.agg(
        F.sum(F.col("positives") * F.col("mean_rank")).alias("ranks"),
        F.coalesce(F.sum("positives"), F.lit(0.0)).alias("p"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )
    pairs = F.nullif(F.col("p") * (F.col("rows") - F.col("p")), F.lit(0.0))
    auc = (F.col("ranks") - F.col("p") * (F.col("p") + 1) / 2) / pairs
    return sums.select(auc.alias("auc"), "rows", F.col("p").cast("bigint").alias("positives"))
