"""One full increment: land a batch, then load what is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sensormart.plans.landing import land_messages
from sensormart.plans.load import load_pending
from sensormart.sources.store import StarStore


def run_increment(store: StarStore, messages: DataFrame, batch: str) -> dict:
    """Land and load one batch. Repeating a batch changes nothing."""
    land_messages(store, messages, batch)
    return load_pending(store)
