"""Column expressions — all built-in Spark functions, no Python UDFs."""

from .casts import (cast_columns, col_of, lenient_int, null_if_token,
                    parse_timestamp, to_date, truncate_int, try_cast)
from .conditionals import at_most, decode, flag, full_match, is_present
from .dates import (age_from_date, age_from_year, as_of_date, days_between,
                    difference, minutes_between, prefix, year_month)
from .keys import key_text, surrogate_key

__all__ = [
    "cast_columns", "col_of", "lenient_int", "null_if_token", "parse_timestamp",
    "to_date", "truncate_int", "try_cast", "at_most", "decode", "flag",
    "full_match", "is_present", "age_from_date", "age_from_year", "as_of_date",
    "days_between", "difference", "minutes_between", "prefix", "year_month",
    "key_text", "surrogate_key",
]
