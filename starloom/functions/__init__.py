"""Column expressions; all of them stay inside whole-stage codegen."""

from starloom.functions.casts import blank_to_null, not_blank, typed
from starloom.functions.dates import calendar_key, date_key, days_between, hours_between, month_of_key
from starloom.functions.numbers import exact_avg, pct, safe_div, weighted_mean
from starloom.functions.text import place_label, title_case

__all__ = [
    "blank_to_null", "not_blank", "typed",
    "calendar_key", "date_key", "days_between", "hours_between", "month_of_key",
    "exact_avg", "pct", "safe_div", "weighted_mean",
    "place_label", "title_case",
]
