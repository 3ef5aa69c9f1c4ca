"""A left join that stays balanced when one key holds much of the right side.

Adaptive execution can split a skewed left side of a left join, but not the right
side, and it splits nothing whose input is the result of an aggregate. Vitals are
aggregated to one row per patient before they meet the history, so a patient id
repeated many times in the history would land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitalgrid.session import staged

#: Right rows of one key that meet in one task.
ROWS_PER_SALT = 100_000
#: A key with more than one in so many rows is looked up by broadcast, so that there are
#: fewer of them than this.
HOT_KEYS = 100_000
_SALT, _SALTS, _ROW, _HIT = "_salt", "_salts", "_row", "_hit"


def hot_keys(df: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Keys with more than ``rows_per_salt`` rows and the salts they need: a table of
    at most one row per ``rows_per_salt`` rows of ``df``. The count combines before
    its shuffle and reads the key only."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    salts = F.ceil(F.col("n") / rows_per_salt).cast("int").alias(_SALTS)
    return counts.where(F.col("n") > rows_per_salt).select(key, salts)


def left_join(
    left: DataFrame, right: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """``left`` ⟕ ``right`` on ``key``, fan-out included.

    Right rows of a hot key are spread over its salts by their place in the input,
    which a retried task sees again unchanged; left rows of that key are repeated once
    per salt. A hot key has a match by definition, so a repeated left row without one
    is a copy whose salt is empty and is dropped. The plan is the same at every size.
    """
    hot = hot_keys(right, key, rows_per_salt)
    none = F.col(_SALTS).isNull()
    every = F.sequence(F.lit(0), F.col(_SALTS) - 1)
    lsalted = left.join(hot, key, "left").withColumn(
        _SALT, F.explode(F.when(none, F.array(F.lit(0))).otherwise(every))
    )
    placed = right.where(F.col(key).isNotNull()).withColumn(_ROW, F.monotonically_increasing_id())
    spread = F.pmod(F.xxhash64(_ROW), F.col(_SALTS)).cast("int")
    rsalted = (
        placed.join(hot, key, "left")
        .withColumn(_SALT, F.when(none, F.lit(0)).otherwise(spread))
        .withColumn(_HIT, F.lit(True))
        .drop(_SALTS, _ROW)
    )
    joined = lsalted.join(rsalted, [key, _SALT], "left")
    return joined.where(none | F.col(_HIT).isNotNull()).drop(_SALT, _SALTS, _HIT)


def lookup(
    left: DataFrame, right: DataFrame, key: str, right_key: str, rows: str, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """``left`` with the columns of the one row of ``right`` that has its key (NULL is a
    key too); every key of ``left`` is there, ``rows`` times in ``left``.

    Rows of a frequent key meet its row where they are; the others are joined by a
    shuffle, in which no key can then fill a task. The plan is the same at every size."""
    right = staged(right, "lookup")
    every = right.agg(F.sum(rows)).first()[0] or 0
    same = F.col(f"`{key}`").eqNullSafe(F.col(f"`{right_key}`"))
    is_hot = F.col(rows) * hot_keys > every
    hot, cold = right.where(is_hot).drop(rows), right.where(~is_hot).drop(rows)
    common = left.join(F.broadcast(hot), same)
    rare = left.join(F.broadcast(hot.select(right_key)), same, "left_anti").join(cold, same)
    return common.unionByName(rare).drop(right_key)
