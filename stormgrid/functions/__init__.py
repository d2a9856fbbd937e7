from stormgrid.functions.numeric import at_least, calendar, in_months, log1p0, right_bins
from stormgrid.functions.parse import (
    nan_to_null, null_if_token, parse_day, parse_ymd, to_int, to_number, to_upper,
)
from stormgrid.functions.text import (
    clean_column_name, fold, normalize_ascii, normalize_key, normalize_text, strip,
)

__all__ = [
    "at_least", "calendar", "clean_column_name", "fold", "in_months", "log1p0", "nan_to_null",
    "normalize_ascii", "normalize_key", "normalize_text", "null_if_token", "parse_day",
    "parse_ymd", "right_bins", "strip", "to_int", "to_number", "to_upper",
]
