"""Composite steps: landing, load, full increment, serving."""

from sensormart.plans.increment import run_increment
from sensormart.plans.landing import land_documents, land_messages
from sensormart.plans.load import IntegrityError, load_into, load_pending
from sensormart.plans.serving import hourly_sums, stored_trend, trend_by_hour, trend_of_sums
from sensormart.plans.star import DIMENSIONS, for_each_dimension, fresh_star

__all__ = [
    "DIMENSIONS",
    "IntegrityError",
    "for_each_dimension",
    "fresh_star",
    "hourly_sums",
    "land_documents",
    "land_messages",
    "load_into",
    "load_pending",
    "run_increment",
    "stored_trend",
    "trend_by_hour",
    "trend_of_sums",
]
