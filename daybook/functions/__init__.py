from daybook.functions.casts import (
    code_page_text,
    fixed_scale_text,
    money,
    moscow_now,
    moscow_time,
    parse_date,
    parse_integer,
    parse_key,
    parse_number,
    text_message,
    to_code_page_bytes,
)
from daybook.functions.periods import (
    Period,
    clip_to_period,
    days_of,
    month_of_report,
    valid_on,
    whole_months_of,
)

__all__ = [
    "Period",
    "clip_to_period",
    "code_page_text",
    "days_of",
    "fixed_scale_text",
    "money",
    "month_of_report",
    "moscow_now",
    "moscow_time",
    "parse_date",
    "parse_integer",
    "parse_key",
    "parse_number",
    "text_message",
    "to_code_page_bytes",
    "valid_on",
    "whole_months_of",
]
