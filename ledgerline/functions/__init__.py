"""Column functions and calendar arithmetic."""

from ledgerline.functions.caltime import (
    business_calendar,
    calendar_from_intervals,
    epoch_seconds,
    format_hms,
    int_div,
    with_business_seconds,
    yyyymm,
)

__all__ = ["business_calendar", "calendar_from_intervals", "epoch_seconds", "format_hms", "int_div", "with_business_seconds", "yyyymm"]
