from tidemark.streaming.ingest import land, start_ingest, start_quarantine
from tidemark.streaming.landing import start_landing
from tidemark.streaming.monitor import start_monitor
from tidemark.streaming.publish import start_publish, to_folder
from tidemark.streaming.running import run_until_any_ends

__all__ = [
    "land",
    "run_until_any_ends",
    "start_ingest",
    "start_landing",
    "start_monitor",
    "start_publish",
    "start_quarantine",
    "to_folder",
]
