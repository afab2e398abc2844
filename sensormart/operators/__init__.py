"""DataFrame -> DataFrame building blocks."""

from sensormart.operators.clean import (
    add_local_time,
    backfill_processed,
    clamp_pressure,
    clean_measurements,
    clean_readings,
    flatten_measurements,
    harmonise_units,
    mark_processed,
    max_pressure,
    not_marked,
    processed,
    split_unusable,
    unprocessed,
    unusable_reason,
)
from sensormart.operators.containment import (
    contained_contents,
    content_columns,
    drop_contained,
    drop_repeats,
    normalise_measurements,
)
from sensormart.operators.dimensions import (
    location_dim,
    new_dimension_rows,
    next_id,
    number_rows,
    parameter_dim,
    resolve_ids,
    time_dim,
)
from sensormart.operators.facts import build_facts, latest_readings, settled_readings
from sensormart.operators.integrity import integrity_violations
from sensormart.operators.paging import cursor_of, latest_page, page_after, with_newest
from sensormart.operators.upsert import first_per_reading, latest_per_key, mark_latest, upsert_facts

__all__ = [
    "add_local_time",
    "backfill_processed",
    "build_facts",
    "clamp_pressure",
    "clean_measurements",
    "clean_readings",
    "contained_contents",
    "content_columns",
    "cursor_of",
    "drop_contained",
    "drop_repeats",
    "first_per_reading",
    "flatten_measurements",
    "harmonise_units",
    "integrity_violations",
    "latest_page",
    "latest_per_key",
    "latest_readings",
    "location_dim",
    "mark_latest",
    "mark_processed",
    "max_pressure",
    "new_dimension_rows",
    "next_id",
    "normalise_measurements",
    "not_marked",
    "number_rows",
    "page_after",
    "parameter_dim",
    "processed",
    "resolve_ids",
    "settled_readings",
    "split_unusable",
    "time_dim",
    "unprocessed",
    "unusable_reason",
    "upsert_facts",
    "with_newest",
]
