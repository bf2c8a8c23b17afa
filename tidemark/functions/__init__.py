from tidemark.functions.messages import failure_message
from tidemark.functions.numbers import integer_accepted, integer_value, real_value
from tidemark.functions.timekeys import (
    calendar_parts,
    date_parts,
    event_hour,
    event_time,
    publish_slot,
    target_day,
)

__all__ = [
    "calendar_parts",
    "date_parts",
    "event_hour",
    "event_time",
    "failure_message",
    "integer_accepted",
    "integer_value",
    "publish_slot",
    "real_value",
    "target_day",
]
