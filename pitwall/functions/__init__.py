from pitwall.functions.timeparse import text_to_seconds, to_seconds, seconds_sql
from pitwall.functions.columns import named
from pitwall.functions.flags import (
    caution_flag,
    rain_flag,
    is_true,
    least_present,
    normalise_nan,
)

__all__ = [
    "named",
    "text_to_seconds",
    "to_seconds",
    "seconds_sql",
    "caution_flag",
    "rain_flag",
    "is_true",
    "least_present",
    "normalise_nan",
]
