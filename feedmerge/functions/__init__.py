from feedmerge.functions.dates import as_date, compact_date, date_series, in_date_range, run_window
from feedmerge.functions.keys import key_bucket, url_key

__all__ = [
    "as_date",
    "compact_date",
    "date_series",
    "in_date_range",
    "key_bucket",
    "run_window",
    "url_key",
]
