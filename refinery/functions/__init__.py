"""Column-expression helpers and fixed rule values."""

from refinery.functions import fixed
from refinery.functions.columns import (
    age_band, age_years, clean_phone, date_lit, day_str, initcap_trim, is_blank,
    is_valid_amount, line_total, lookup, lower_trim, loyalty, money_sum, month_str,
    parse_date, parse_flag, tenure_days, timestamp_str, to_double, to_int, truncate,
    upper_trim, valid_email, with_tax, year_str,
)

__all__ = [
    "fixed", "age_band", "age_years", "clean_phone", "date_lit", "day_str", "initcap_trim",
    "is_blank", "is_valid_amount", "line_total", "lookup", "lower_trim", "loyalty",
    "money_sum", "month_str", "parse_date", "parse_flag", "tenure_days", "timestamp_str",
    "to_double", "to_int", "truncate", "upper_trim", "valid_email", "with_tax", "year_str",
]
