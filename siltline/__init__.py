"""Spark-native change-feed engine: bronze change feeds in, keyed current-state tables out."""

from siltline.operators.changes import change_feed
from siltline.operators.conform import change_events, conform_main, conform_recon
from siltline.operators.upsert import current, split_rejects, upsert
from siltline.plans.spec import EntitySpec, Null, Source
from siltline.streaming.runner import run, start_entity
from siltline.streaming.target import KeyedTable

__all__ = [
    "EntitySpec",
    "KeyedTable",
    "Null",
    "Source",
    "change_events",
    "change_feed",
    "conform_main",
    "conform_recon",
    "current",
    "run",
    "split_rejects",
    "start_entity",
    "upsert",
]
