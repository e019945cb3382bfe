"""Column helpers. All of them build native expressions; none is a UDF."""

from inplay.functions.dates import as_date, month_start, season
from inplay.functions.labels import (
    as_label, count_where, display_name, hit_label, label_text, sign_label, threshold_label,
)
from inplay.functions.numbers import percent, percent_text, rate, round_half_even, safe_ratio, thousands

__all__ = [
    "as_date", "month_start", "season",
    "as_label", "count_where", "display_name", "hit_label", "label_text", "sign_label", "threshold_label",
    "percent", "percent_text", "rate", "round_half_even", "safe_ratio", "thousands",
]
