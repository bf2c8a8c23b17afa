from tidemark.sources.json_responses import (
    observation_items,
    parse_weather,
    pivot_observations,
)
from tidemark.sources.lake import (
    days_since,
    last_change,
    read_days,
    read_raw,
    read_set_aside,
    read_summary,
    within,
    write_days,
)
from tidemark.sources.messages import file_messages, kafka_messages, publish
from tidemark.sources.responses import accepted, reject_report, rejected
from tidemark.sources.staged import IncompleteError, read_committed, settle, stage_days
from tidemark.sources.wire import (
    decode,
    decode_once,
    decode_with_corrupt,
    encode,
    quarantine_split,
)
from tidemark.sources.xml_responses import parse_power

__all__ = [
    "IncompleteError",
    "accepted",
    "days_since",
    "decode",
    "decode_once",
    "decode_with_corrupt",
    "encode",
    "file_messages",
    "kafka_messages",
    "last_change",
    "observation_items",
    "parse_power",
    "parse_weather",
    "pivot_observations",
    "publish",
    "quarantine_split",
    "read_committed",
    "read_days",
    "read_raw",
    "read_set_aside",
    "read_summary",
    "reject_report",
    "rejected",
    "settle",
    "stage_days",
    "within",
    "write_days",
]
