from vitalgrid.functions.labels import age_band, is_alert, risk_status
from vitalgrid.functions.numbers import fill_number, round_stable, to_bigint, to_number
from vitalgrid.functions.text import bp_text, bp_diastolic, bp_systolic
from vitalgrid.functions.times import iso_utc, parse_iso, run_stamp

__all__ = [
    "age_band",
    "bp_diastolic",
    "bp_systolic",
    "bp_text",
    "fill_number",
    "is_alert",
    "iso_utc",
    "parse_iso",
    "risk_status",
    "round_stable",
    "run_stamp",
    "to_bigint",
    "to_number",
]
