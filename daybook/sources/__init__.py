from daybook.sources.bucketed import write_bucketed
from daybook.sources.checked import Loaded, read_checked
from daybook.sources.readers import read_delimited, read_form101_csv, read_table
from daybook.sources.writers import (
    merge_days,
    overwrite_table,
    replace_days,
    write_by_day,
    write_delimited,
)

__all__ = [
    "Loaded",
    "merge_days",
    "overwrite_table",
    "read_checked",
    "read_delimited",
    "read_form101_csv",
    "read_table",
    "replace_days",
    "write_bucketed",
    "write_by_day",
    "write_delimited",
]
