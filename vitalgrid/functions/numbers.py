"""Rounding and coercion as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text that a numeric parser accepts. Java's parser also takes "1d" and hex
# floats, which are not numbers in a CSV file.
NUMBER_PATTERN = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def round_stable(x: Column, digits: int) -> Column:
    """Half-up rounding as by a decimal with eight digits, so that the last bit of a
    sum taken in another order does not change the result.

    Away from a tie the nearest whole number of units is beyond doubt, and dividing it
    gives the double nearest to the decimal; only values close to a tie pay for the
    decimal. It holds numbers below 10^12; larger ones, and NaN, keep plain rounding.
    """
    unit = float(10**digits)
    scaled = x * unit
    whole = F.rint(scaled)
    clear = (F.abs(scaled) < 1e12) & (F.abs(scaled - whole) < 0.49)
    exact = F.round(x.try_cast("decimal(20,8)"), digits).cast("double")
    # Adding 0.0 turns -0.0 into 0.0.
    return F.when(clear, whole / unit + 0.0).otherwise(
        F.coalesce(exact, F.round(x.cast("double"), digits))
    )


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    text = text.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_bigint(text: Column) -> Column:
    """Text to bigint; also takes whole numbers written with a fraction."""
    return F.coalesce(text.try_cast("bigint"), to_number(text).try_cast("bigint"))


def fill_number(x: Column) -> Column:
    """Replace NULL and NaN by 0."""
    return F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))
