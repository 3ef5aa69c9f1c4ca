"""UTC stamps as text, whatever the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _utc_text(ts: Column) -> Column:
    """UTC wall clock to the second. It is reckoned from the epoch without a time
    zone, because a local time may be missing or doubled where clocks change."""
    seconds = F.floor(F.unix_micros(ts) / 1_000_000)
    days = F.floor(seconds / 86_400)
    clock = F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), (seconds - days * 86_400).cast("decimal(18,6)"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (epoch + clock).cast("string")


def iso_utc(ts: Column) -> Column:
    """ISO-8601 with a trailing Z; the fraction is left out when it is zero."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    whole = F.replace(_utc_text(ts), F.lit(" "), F.lit("T"))
    fraction = F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    return F.concat(whole, F.when(micros == 0, "").otherwise(fraction), F.lit("Z"))


def run_stamp(ts: Column) -> Column:
    """Second-resolution stamp that names a run."""
    return F.replace(F.translate(_utc_text(ts), "-:", ""), F.lit(" "), F.lit("_"))


def parse_iso(text: Column) -> Column:
    """ISO text to timestamp; text that is no timestamp becomes NULL."""
    return F.try_to_timestamp(text)
