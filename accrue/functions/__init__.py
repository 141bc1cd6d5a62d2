from accrue.functions.aggregates import exact_sum, last_non_null
from accrue.functions.periods import (
    DEFAULT_PERIOD,
    Period,
    check_fixed_offset,
    parse_period,
    period_end,
    period_start,
    with_period,
)
from accrue.functions.timestamps import from_epoch, now_utc, to_utc, utc_column

__all__ = [
    "DEFAULT_PERIOD",
    "Period",
    "check_fixed_offset",
    "exact_sum",
    "from_epoch",
    "last_non_null",
    "now_utc",
    "parse_period",
    "period_end",
    "period_start",
    "to_utc",
    "utc_column",
    "with_period",
]
