"""A whole star schema from raw documents, for analysis without a store."""

from __future__ import annotations

import contextvars
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from sensormart.operators import (
    build_facts,
    clean_measurements,
    location_dim,
    number_rows,
    parameter_dim,
    settled_readings,
    time_dim,
)
from sensormart.schemas import (
    FACT_TABLE,
    ID_COLUMNS,
    LOCATION_TABLE,
    NATURAL_KEYS,
    PARAMETER_TABLE,
    TIME_TABLE,
)
from sensormart.session import materialise

DIMENSIONS = {
    LOCATION_TABLE: location_dim,
    PARAMETER_TABLE: parameter_dim,
    TIME_TABLE: time_dim,
}


def for_each_dimension(action) -> dict[str, DataFrame]:
    """``action(table, extract)`` for the three dimensions, their jobs side by side."""
    # Each thread knows the copies that the caller will remove.
    contexts = [contextvars.copy_context() for _ in DIMENSIONS]
    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        results = pool.map(lambda c, t: c.run(action, t, DIMENSIONS[t]), contexts, DIMENSIONS)
        return dict(zip(DIMENSIONS, results))


def fresh_star(documents: DataFrame) -> dict[str, DataFrame]:
    """Dimensions numbered from 1 and one fact per key; the documents' ids are distinct."""
    clean = clean_measurements(documents)
    star = for_each_dimension(
        lambda table, extract: number_rows(extract(clean), NATURAL_KEYS[table], ID_COLUMNS[table])
    )
    # Written once: several queries of the star read the facts more than once.
    latest = settled_readings(documents).filter("latest")
    facts = materialise(build_facts(latest, *star.values()), "facts")
    return {**star, FACT_TABLE: facts}
