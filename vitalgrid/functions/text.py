"""Blood-pressure text: ``systolic/diastolic``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vitalgrid.functions.numbers import to_number


def bp_text(systolic: Column, diastolic: Column) -> Column:
    """Join two readings; a missing one is left out, both missing give ''."""
    return F.concat_ws("/", systolic.cast("string"), diastolic.cast("string"))


def bp_systolic(bp: Column) -> Column:
    """Number before the first slash, or the whole text when there is none."""
    return to_number(F.get(F.split(bp, "/", 2), F.lit(0)))


def bp_diastolic(bp: Column) -> Column:
    """Number after the first slash; NULL without a slash."""
    return to_number(F.get(F.split(bp, "/", 2), F.lit(1)))
