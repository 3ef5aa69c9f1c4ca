"""How two columns go together, in one pass or by ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitalgrid.operators.ranking import ranked_groups
from vitalgrid.session import staged


def correlations(df: DataFrame, x: str, y: str) -> DataFrame:
    """``rows``, ``pearson``, ``spearman`` in one row, over rows with both values; NaN
    counts as none. NULL where a column has fewer than two different values.

    Pearson's comes from co-moments about running means, which tasks merge, so it does
    not suffer from large means. Spearman's is the same of mean ranks: both columns are
    ranked over range partitions, rows are counted per pair of values, and ranks are
    taken from their mean (n + 1) / 2, which is known beforehand."""
    known = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in (x, y)]
    rows = staged(df.select(*known).where(f"`{x}` IS NOT NULL AND `{y}` IS NOT NULL"), "pairs")
    one_pass = F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
    n, pearson = rows.agg(F.count("*"), one_pass).first()
    ranks = [ranked_groups(rows, c).select(c, (F.col("mean_rank") - (n + 1) / 2).alias(f"_{side}")) for c, side in ((x, "x"), (y, "y"))]
    pairs = rows.groupBy(x, y).agg(F.count("*").alias("_n")).join(ranks[0], x).join(ranks[1], y)
    moment = lambda a, b: F.sum(F.col("_n") * F.col(a) * F.col(b))
    spread = F.sqrt(moment("_x", "_x")) * F.sqrt(moment("_y", "_y"))
    spearman = (moment("_x", "_y") / F.nullif(spread, F.lit(0.0))).alias("spearman")
    return pairs.agg(F.lit(n).cast("bigint").alias("rows"), F.lit(pearson).cast("double").alias("pearson"), spearman)
