"""Scalar column functions (JVM-side expressions, no Python UDFs)."""

from squall.functions.numeric import celsius_to_fahrenheit, code_to_label, round_dp, to_number
from squall.functions.text import (blank_to_null, categorise, contains_any, extract_predicate,
                                   first_translation, matches_any, null_to_empty, route_from_header,
                                   strip, weather_keyword_predicate)
from squall.functions.timefn import (as_instant, epoch_micros, epoch_seconds_timestamp,
                                     lenient_timestamp, plus_seconds, round_to, strict_timestamp,
                                     utc_date)

__all__ = [
    "as_instant", "blank_to_null", "categorise", "celsius_to_fahrenheit", "code_to_label",
    "contains_any", "epoch_micros", "epoch_seconds_timestamp", "extract_predicate",
    "first_translation", "lenient_timestamp", "matches_any", "null_to_empty", "plus_seconds",
    "round_dp", "round_to", "route_from_header", "strict_timestamp", "strip", "to_number",
    "utc_date", "weather_keyword_predicate",
]
