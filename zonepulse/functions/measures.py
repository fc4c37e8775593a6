"""Trip measures derived per row, all JVM-side and safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_MINUTE = 60.0
SECONDS_PER_HOUR = 3600.0


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_minutes(seconds: str | Column = "trip_duration") -> Column:
    return _c(seconds) / F.lit(SECONDS_PER_MINUTE)


def duration_hours(seconds: str | Column = "trip_duration") -> Column:
    return _c(seconds) / F.lit(SECONDS_PER_HOUR)


def speed_mph(distance: str | Column = "trip_distance", hours: str | Column = "trip_duration_hr") -> Column:
    """Miles per hour. ``try_divide`` turns a zero duration into NULL
    instead of failing the job with DIVIDE_BY_ZERO under ANSI mode."""
    return F.try_divide(_c(distance), _c(hours))


def finite_or_null(c: str | Column) -> Column:
    """Replace +inf by NULL (inf can only arrive with the input data)."""
    col = _c(c)
    return F.when(col == F.lit(float("inf")), F.lit(None).cast("double")).otherwise(col)
