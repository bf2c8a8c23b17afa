from tidemark.plans.runs import days_done, failure_messages, read_run_log, run_range
from tidemark.plans.summary import (
    daily_summary,
    full_scan_summary,
    summary_range,
    write_changed_days,
    write_daily_summary,
    write_range,
    write_touched_days,
)

__all__ = [
    "daily_summary",
    "days_done",
    "failure_messages",
    "full_scan_summary",
    "read_run_log",
    "run_range",
    "summary_range",
    "write_changed_days",
    "write_daily_summary",
    "write_range",
    "write_touched_days",
]
