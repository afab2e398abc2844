"""Instants as text -> wall-clock times, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Europe/Paris"  # fixed value


def epoch_seconds(text: Column) -> Column:
    """Seconds since 1970 UTC of an ISO text; NULL when it is malformed.

    A text without an offset is read as UTC. Spark alone would read it in the
    session's zone, so the same file would give other results elsewhere. Blanks
    around the text do not count, and a year, month, day, hour or minute may be
    its last part.
    """
    text = F.trim(text)
    # An offset needs seconds in front of it.
    text = F.regexp_replace(text, r"^(\d{4,}-\d{1,2}-\d{1,2}[T ]\d{1,2})(Z|[+-].*)?$", "$1:00:00$2")
    text = F.regexp_replace(text, r"^(\d{4,}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2})(Z|[+-].*)?$", "$1:00$2")
    zoned = (
        text.endswith("Z")
        | text.contains("+")
        | F.substring(text, 11, 100).contains("-")
        | text.rlike("[A-Za-z]$")
    )
    completed = (
        F.when(zoned, text)
        .when(text.rlike(r"^\d{4}$"), F.concat(text, F.lit("-01-01T00:00:00Z")))
        .when(text.rlike(r"^\d{4}-\d{1,2}$"), F.concat(text, F.lit("-01T00:00:00Z")))
        .when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.concat(text, F.lit("T00:00:00Z")))
        .otherwise(F.concat(text, F.lit("Z")))
    )
    # Spark completes a bare time of day with today's date: only a date counts.
    dated = F.when(F.substring(completed, 5, 1) == "-", completed)
    return F.unix_seconds(F.try_to_timestamp(dated))


def _wall_clock(seconds: Column) -> Column:
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.timestamp_add("SECOND", seconds, epoch)


def utc_wall_clock(seconds: Column) -> Column:
    """UTC clock reading (``timestamp_ntz``) of an instant in epoch seconds."""
    return _wall_clock(seconds)


def local_wall_clock(seconds: Column, zone: str = LOCAL_ZONE) -> Column:
    """Clock reading (``timestamp_ntz``) in ``zone`` of an instant in epoch seconds.

    ``from_utc_timestamp`` moves the instant by the zone's offset; its seconds
    are then the wanted clock reading, whatever the session zone is.
    """
    shifted = F.from_utc_timestamp(F.timestamp_seconds(seconds), zone)
    return _wall_clock(F.unix_seconds(shifted))


def zoned_text(clock: Column, zone: str | None = None) -> Column:
    """``2024-07-01T14:00:00+02:00``: a clock reading with the offset of ``zone`` at that time.

    Without ``zone`` the session's is taken. Of a clock reading that comes twice, the
    first is meant. No offset is written as ``Z``.
    """
    if zone is None:
        return F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ssXXX")
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    seconds = F.timestamp_diff("SECOND", epoch, clock)
    instant = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(seconds), zone))
    minutes = ((seconds - instant) / 60).cast("int")
    size = F.abs(minutes)
    offset = F.format_string("%s%02d:%02d", F.when(minutes < 0, "-").otherwise("+"), F.floor(size / 60), size % 60)
    text = F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(text, F.when(minutes == 0, "Z").otherwise(offset))
