"""Unit harmonisation: rules as data, folded into one CASE per column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Factors to ug/m3 (and to Pa for pressure). The factors of no and ch4 are
# approximate. A pair that is not listed keeps its value: particulate matter
# in ug/m3, black carbon, pressure in pa and everything unknown.
FACTORS = {
    "co": {"ppm": 1145.94, "ppb": 1.14594},
    "no2": {"ppm": 1912.87, "ppb": 1.91287},
    "so2": {"ppm": 2620.8, "ppb": 2.6208},
    "o3": {"ppb": 2.0},
    "no": {"ppm": 1230.0, "ppb": 1.23},
    "ch4": {"ppm": 655.66},
    "pressure": {"hpa": 100.0, "mb": 100.0},
}
MASS_CONCENTRATION = "µg/m³"
# parameters -> (units to relabel, or None for any unit; the new label)
RELABELS = [
    (("co", "no2", "so2", "o3", "no", "ch4"), ("ppm", "ppb"), MASS_CONCENTRATION),
    (("pm25", "pm4", "pm10", "bc"), None, MASS_CONCENTRATION),
    (("pressure",), ("hpa", "mb"), "Pa"),
    (("temperature",), ("f", "k", "c"), "°C"),
]
RENAMES = {"relativehumidity": "humidity"}
PRESSURE_BAND = (87000.0, 108400.0)  # plausible pressure in Pa, both ends allowed
# ----------------------------------------------------------------------------


def converted_value(parameter: Column, unit: Column, value: Column) -> Column:
    """``value`` in the target unit. ``parameter`` is lower case, ``unit`` as delivered."""
    case = F
    for name, factors in FACTORS.items():
        inner = F
        for label, factor in factors.items():
            inner = inner.when(unit == label, value * F.lit(factor))
        case = case.when(parameter == name, inner.otherwise(value))
    degrees = (
        F.when(unit == "f", (value - 32) * 5 / 9).when(unit == "k", value - 273.15).otherwise(value)
    )
    return case.when(parameter == "temperature", degrees).otherwise(value)


def harmonised_unit(parameter: Column, unit: Column, strict: bool = False) -> Column:
    """The unit label after conversion.

    By default some labels change although no conversion exists (o3 in ppm, ch4
    in ppb, particulates in counts). ``strict`` leaves such units alone.
    """
    case = F
    for names, labels, target in RELABELS:
        hit = parameter.isin(*names)
        if labels is not None:
            hit = hit & unit.isin(*labels)
        if strict:
            hit = hit & _comparable(names, labels, parameter, unit)
        case = case.when(hit, F.lit(target))
    return case.otherwise(unit)


def _comparable(names: tuple, labels: tuple | None, parameter: Column, unit: Column) -> Column:
    """True where the value really is in the target unit after conversion."""
    if labels is None:
        return unit == MASS_CONCENTRATION
    known = F.lit(names == ("temperature",))
    for name in names:
        for label in FACTORS.get(name, {}):
            known = known | ((parameter == name) & (unit == label))
    return known


def harmonised_name(parameter: Column) -> Column:
    """The parameter's common name."""
    case = F
    for old, new in RENAMES.items():
        case = case.when(parameter == old, F.lit(new))
    return case.otherwise(parameter)


def clamp(value: Column, low: float, high: float) -> Column:
    """``value`` limited to [low, high]; NULL stays NULL (unlike least/greatest)."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)
