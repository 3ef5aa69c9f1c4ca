"""Consecutive row numbers over a whole table, without one task seeing all rows."""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitalgrid.session import cut_lineage

_SRC, _ID = "_src", "_id"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in its low 33 bits


def number_rows(
    df: DataFrame, order: list[str], name: str = "row_number", total: str | None = None
) -> DataFrame:
    """Number rows 1..n by ``order``; ``total`` names a column that gets n.

    Rows are range-partitioned and sorted within the partitions; the split they came
    from breaks ties, so that many equal order values still spread. The checkpoint
    fixes each row's place, and the number is that place plus the count of rows in
    the partitions before, so the rows move only once.
    """
    keys = [*order, _SRC]
    ranged = df.withColumn(_SRC, F.spark_partition_id()).repartitionByRange(*keys)
    placed = ranged.sortWithinPartitions(*keys).withColumn(_ID, F.monotonically_increasing_id())
    placed = cut_lineage(placed.drop(_SRC))
    part = F.shiftrightunsigned(_ID, _ROW_BITS)
    place = F.col(_ID).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per partition, hence as many rows as shuffle partitions at most.
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    counts.sort(key=lambda c: c.part)
    starts = [0, *accumulate(c.n for c in counts)]
    rows = starts.pop()
    # An Arrow table of this size becomes a local relation, without Python workers.
    offsets = df.sparkSession.createDataFrame(
        pa.table(
            {
                "_part": pa.array([c.part for c in counts], pa.int64()),
                "_start": pa.array(starts, pa.int64()),
            }
        )
    )
    numbered = placed.join(F.broadcast(offsets), part == F.col("_part")).withColumn(
        name, place + 1 + F.col("_start")
    )
    if total:
        numbered = numbered.withColumn(total, F.lit(rows).cast("bigint"))
    return numbered.drop(_ID, "_part", "_start")
