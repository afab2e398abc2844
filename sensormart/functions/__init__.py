"""Column expressions. All are built-in Spark expressions, no UDF."""

from sensormart.functions.time import (
    LOCAL_ZONE,
    epoch_seconds,
    local_wall_clock,
    utc_wall_clock,
    zoned_text,
)
from sensormart.functions.units import clamp, converted_value, harmonised_name, harmonised_unit

__all__ = [
    "LOCAL_ZONE",
    "clamp",
    "converted_value",
    "epoch_seconds",
    "harmonised_name",
    "harmonised_unit",
    "local_wall_clock",
    "utc_wall_clock",
    "zoned_text",
]
