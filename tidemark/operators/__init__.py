from tidemark.operators.alerts import RESERVE_THRESHOLD_MW, reserve_alerts
from tidemark.operators.dedup import dedup, dedup_wide
from tidemark.operators.hourly import (
    hour_bucket,
    hourly_join,
    hourly_summary,
    summarise_days,
    temp_demand_corr,
)
from tidemark.operators.presence import day_presence, days_skipped, days_with_both

__all__ = [
    "RESERVE_THRESHOLD_MW",
    "day_presence",
    "days_skipped",
    "days_with_both",
    "dedup",
    "dedup_wide",
    "hour_bucket",
    "hourly_join",
    "hourly_summary",
    "reserve_alerts",
    "summarise_days",
    "temp_demand_corr",
]
