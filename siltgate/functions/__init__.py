from siltgate.functions.dates import DATE_FORMATS, days_before, month_bucket, parse_date
from siltgate.functions.numbers import not_negative
from siltgate.functions.text import blank_out, lower_trimmed, quoted, title_case, unused

__all__ = [
    "DATE_FORMATS",
    "blank_out",
    "days_before",
    "lower_trimmed",
    "month_bucket",
    "not_negative",
    "parse_date",
    "quoted",
    "title_case",
    "unused",
]
