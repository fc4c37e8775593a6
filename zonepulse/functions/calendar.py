"""Calendar labels and calendar parts as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday labels in natural order. A label's place in the list
# is its number (0 = Monday, the convention of Spark's ``weekday()``).
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _labels() -> Column:
    return F.array(*[F.lit(day) for day in WEEKDAYS])


def label_weekdays(counts: DataFrame, measure: str, *keys: str) -> DataFrame:
    """Weekday counts with ``day_name`` in place of ``day_of_week``. Labels
    meet the few aggregated rows, not the trips; numbers without a label
    (and NULL) share the NULL label, so their counts add up."""
    by_number = F.map_from_arrays(F.sequence(F.lit(0), F.lit(len(WEEKDAYS) - 1)), _labels())
    named = counts.withColumn("day_name", by_number[F.col("day_of_week")])
    return named.groupBy("day_name", *keys).agg(F.sum(measure).alias(measure))


def weekday_position(day_name: str = "day_name") -> Column:
    """Sort key Monday to Sunday: 1 to 7, 0 for an unknown label, NULL first."""
    return F.array_position(_labels(), F.col(day_name))


def time_parts(ts: str | Column) -> dict[str, Column]:
    """``year, month, day, day_of_week (0 = Mon), hour_of_day`` of a timestamp."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return {
        "year": F.year(col),
        "month": F.month(col),
        "day": F.dayofmonth(col),
        "day_of_week": F.weekday(col),
        "hour_of_day": F.hour(col),
    }


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(ts: str | Column, dtype: str = "timestamp_ntz") -> Column:
    """Microseconds since 1970-01-01 00:00, independent of the session
    time zone: a TIMESTAMP_NTZ wall clock is read as UTC, a TIMESTAMP is an
    instant already.

    Built from calendar parts (days since the epoch, hour, minute, seconds
    with fraction), which never consult the session zone;
    ``timestamp_diff`` on NTZ values does, and shifts wall clocks that fall
    in a daylight-saving gap."""
    col = F.col(ts) if isinstance(ts, str) else ts
    if dtype == "timestamp":
        return F.unix_micros(col)
    return (
        F.unix_date(F.to_date(col)).cast("long") * F.lit(86_400_000_000)
        + F.hour(col).cast("long") * F.lit(3_600_000_000)
        + F.minute(col).cast("long") * F.lit(60_000_000)
        + (F.date_part(F.lit("SECOND"), col) * F.lit(1_000_000)).cast("long")
    )


def epoch_seconds(ts: str | Column, dtype: str = "timestamp_ntz") -> Column:
    """Whole seconds since the epoch (floor), session-time-zone independent."""
    return F.floor(epoch_micros(ts, dtype) / F.lit(1_000_000))


def instant_from_ntz(ts: str | Column) -> Column:
    """TIMESTAMP instant of a TIMESTAMP_NTZ wall clock read as UTC."""
    return F.timestamp_micros(epoch_micros(ts))


def ntz_from_instant(ts: str | Column) -> Column:
    """TIMESTAMP_NTZ wall clock (UTC) of a TIMESTAMP instant."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("MICROSECOND", F.unix_micros(col), _epoch_ntz())
