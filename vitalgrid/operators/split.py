"""Exact stratified split.

Rows are put in a hashed order within their class and the first part goes to
``test``. Ranking a whole class would need it in one task. Instead the cut point
of each class is found by counting: hash ranges first, then narrower ones inside the
one that holds the cut. With the cuts known the split is a comparison on each row; only
the rows at the cut itself are ranked, by distributed numbering.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.config import SPLIT_SEED, TEST_SHARE
from vitalgrid.operators.joins import lookup
from vitalgrid.operators.numbering import number_rows
from vitalgrid.session import staged

ORDER_BITS = 32
SHIFTS = (20, 8, 0)  # a range is cut into 2^12 narrower ones, so a task emits few counts
_O, _CELL, _NEED, _LABEL, _WEIGHT = "_order", "_cell", "_need", "_label", "_weight"


def hashed_order(key: Column, seed: int = SPLIT_SEED) -> Column:
    """Order of rows within a class: a hash between 0 and 2^32 - 1."""
    return F.xxhash64(key, F.lit(seed)).bitwiseAND(F.lit((1 << ORDER_BITS) - 1))


def _cuts(counts: DataFrame) -> DataFrame:
    """Of each class the cell in which the running count reaches ``need``, and how many
    of its rows are ``test``. A class has at most 2^12 cells here."""
    order = Window.partitionBy(_LABEL).orderBy(_CELL)
    running = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        counts.withColumn("upto", running)
        .where(f"{_NEED} > upto - n AND {_NEED} <= upto")
        .select(_LABEL, _CELL, (F.col(_NEED) - F.col("upto") + F.col("n")).alias(_NEED))
    )


def find_cuts(narrow: DataFrame, share: float) -> DataFrame:
    """One row per class: the order value at which it is cut, and how many rows with
    that value are ``test``. A class without test rows has none. A row counts as many
    times as its weight, if it has one."""
    size = F.sum(_WEIGHT) if _WEIGHT in narrow.columns else F.count("*")
    sizes = narrow.groupBy(_LABEL).agg(size.alias("n"))
    wanted = F.ceil(F.col("n") * F.lit(Decimal(str(share)))).cast("bigint")
    cuts = sizes.select(_LABEL, wanted.alias(_NEED))
    above = None
    for shift in SHIFTS:
        cell = F.shiftright(_O, shift)
        rows = narrow
        if above is not None:
            inside = cuts.select(F.col(_LABEL).alias("l"), F.col(_CELL).alias("c"))
            rows = narrow.join(inside, F.col(_LABEL).eqNullSafe(F.col("l")) & (F.shiftright(_O, above) == F.col("c")), "left_semi")
        counts = rows.groupBy(_LABEL, cell.alias(_CELL)).agg(size.alias("n"))
        need = cuts.select(F.col(_LABEL).alias("l"), _NEED)
        counts = counts.join(need, F.col(_LABEL).eqNullSafe(F.col("l"))).drop("l")
        # One row per class.
        cuts, above = staged(_cuts(counts), "cuts"), shift
    return cuts


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    share: float = TEST_SHARE,
    order: Column | None = None,
    name: str = "part",
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Add ``part``: of each class, ``ceil(share * n)`` rows are ``test``, the others
    ``train``. Rows come in the order of ``order`` (0 .. 2^32 - 1; by default a hash
    with ``seed``), then ``key``; copies of a key in any order."""
    k, l = F.col(f"`{key}`"), F.col(f"`{label}`")
    o = hashed_order(k, seed) if order is None else order
    # Read by every pass, so written once.
    narrow = staged(df.select(l.alias(_LABEL), o.alias(_O)), "order")
    cuts = find_cuts(narrow, share).withColumnRenamed(_LABEL, "_cut_label")
    placed = df.withColumn(_O, o).join(cuts, l.eqNullSafe(F.col("_cut_label")), "left")
    helpers = (_O, _CELL, _NEED, "_cut_label")
    at_cut = F.coalesce(F.col(_O) == F.col(_CELL), F.lit(False))
    part = F.when(F.col(_O) < F.col(_CELL), "test").otherwise("train")
    clear = placed.where(~at_cut).withColumn(name, part)
    # Rows of a class at its cut: numbered over all classes, then from the class's first.
    ranked = number_rows(placed.where(at_cut), [label, key], "_n")
    first = ranked.groupBy(l.alias("_first_label")).agg(F.min("_n").alias("_first"))
    ranked = ranked.join(first, l.eqNullSafe(F.col("_first_label"))).withColumn(
        name, F.when(F.col("_n") - F.col("_first") < F.col(_NEED), "test").otherwise("train")
    )
    return clear.drop(*helpers).unionByName(ranked.drop(*helpers, "_n", "_first", "_first_label"))


def group_split(
    df: DataFrame,
    label: str,
    key: str,
    share: float = TEST_SHARE,
    order: Column | None = None,
    name: str = "part",
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Add ``part`` so that all rows of a ``key`` are in the same one. The class of a key
    is its greatest label. Of each class, keys come in the order of ``order``, then
    ``key``; they are ``test`` up to the key with which ``ceil(share * rows)`` rows are
    reached, so the share is exact within the rows of one key. Rows without a key are
    one key. Keys that share a value of ``order`` at the cut are ranked in one task."""
    k = F.col(f"`{key}`")
    groups = df.groupBy(k).agg(F.max(f"`{label}`").alias(_LABEL), F.count("*").alias(_WEIGHT))
    o = hashed_order(k, seed) if order is None else order
    # Read by every pass and by the join, so written once.
    groups = staged(groups.withColumn(_O, o).withColumnRenamed(key, "_key"), "groups")
    cuts = find_cuts(groups.select(_LABEL, _O, _WEIGHT), share).withColumnRenamed(_LABEL, "_cut_label")
    placed = groups.join(cuts, F.col(_LABEL).eqNullSafe(F.col("_cut_label")), "left")
    at_cut = F.coalesce(F.col(_O) == F.col(_CELL), F.lit(False))
    before = F.sum(_WEIGHT).over(Window.partitionBy(_LABEL).orderBy("_key")) - F.col(_WEIGHT)
    clear = placed.where(~at_cut).withColumn(name, F.when(F.col(_O) < F.col(_CELL), "test").otherwise("train"))
    near = placed.where(at_cut).withColumn(name, F.when(before < F.col(_NEED), "test").otherwise("train"))
    parts = clear.select("_key", _WEIGHT, name).unionByName(near.select("_key", _WEIGHT, name))
    return lookup(df, parts, key, "_key", _WEIGHT)
