"""Raw -> silver: validity filters (F1-F6), derived measures (P1-P5), the
composed cleaner (F10) and the one-pass quality funnel (I4).

Every step is a filter or projection, so the whole cleaner is a single
narrow stage: Catalyst merges the filters into one predicate and pushes the
simple comparisons into the Parquet scan. No shuffle happens before a
silver write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.functions.measures import (
    duration_hours,
    duration_minutes,
    finite_or_null,
    speed_mph,
)

# Validity bounds (strict unless noted) and the ordered
# silver column list.
MIN_DISTANCE, MAX_DISTANCE = 0.0, 100.0  # miles, strict
MIN_DURATION, MAX_DURATION = 60, 14400  # seconds, strict
MIN_SPEED, MAX_SPEED = 0.0, 80.0  # mph, strict
SILVER_COLUMNS = [
    "trip_distance",
    "pickup_location_id",
    "dropoff_location_id",
    "year",
    "month",
    "day",
    "day_of_week",
    "hour_of_day",
    "trip_duration_min",
    "avg_speed_mph",
    "fare_amount",
    "tip_amount",
    "total_amount",
]


# The raw-trip column contract (``total_amount`` optional).
REQUIRED_RAW = [
    "trip_distance",
    "trip_duration",
    "pickup_location_id",
    "dropoff_location_id",
    "year",
    "month",
    "day",
    "day_of_week",
    "hour_of_day",
    "fare_amount",
    "tip_amount",
]
OPTIONAL_RAW = ["total_amount"]


def check_raw_columns(df: DataFrame) -> DataFrame:
    """Fail early, naming every missing required column (schema only, no
    job); optional columns may be absent."""
    missing = [c for c in REQUIRED_RAW if c not in df.columns]
    if missing:
        raise ValueError(f"raw trips lack required columns: {missing}")
    return df


# -- predicates (Column-level, reused by the filters and by the funnel) -----

def distance_ok(lo: float = MIN_DISTANCE, hi: float = MAX_DISTANCE) -> Column:
    d = F.col("trip_distance")
    return (d > F.lit(lo)) & (d < F.lit(hi))


def duration_ok(lo: int = MIN_DURATION, hi: int = MAX_DURATION) -> Column:
    d = F.col("trip_duration")
    return (d > F.lit(lo)) & (d < F.lit(hi))


def amount_ok() -> Column:
    return F.col("total_amount") > F.lit(0)


def locations_ok() -> Column:
    p, d = F.col("pickup_location_id"), F.col("dropoff_location_id")
    return p.isNotNull() & d.isNotNull() & (p > F.lit(0)) & (d > F.lit(0))


def _speed_expr() -> Column:
    return finite_or_null(speed_mph("trip_distance", duration_hours("trip_duration")))


def speed_present(speed: Column | None = None) -> Column:
    """``na.drop`` semantics: NULL and NaN are both missing."""
    s = _speed_expr() if speed is None else speed
    return s.isNotNull() & ~F.isnan(s)


def speed_ok(speed: Column | None = None, lo: float = MIN_SPEED, hi: float = MAX_SPEED) -> Column:
    s = _speed_expr() if speed is None else speed
    return (s > F.lit(lo)) & (s < F.lit(hi))


# -- DataFrame operators -----------------------------------------------------

def filter_distance(df: DataFrame, lo: float = MIN_DISTANCE, hi: float = MAX_DISTANCE) -> DataFrame:
    """``lo < trip_distance < hi``; NULL never passes and NaN (which
    Spark orders above every number) fails the upper bound."""
    return df.filter(distance_ok(lo, hi))


def filter_duration(df: DataFrame, lo: int = MIN_DURATION, hi: int = MAX_DURATION) -> DataFrame:
    """``lo < trip_duration < hi`` seconds."""
    return df.filter(duration_ok(lo, hi))


def filter_total_amount(df: DataFrame) -> DataFrame:
    """``total_amount > 0``, applied only when the column exists."""
    return df.filter(amount_ok()) if "total_amount" in df.columns else df


def filter_locations(df: DataFrame) -> DataFrame:
    """both location ids present and positive."""
    return df.filter(locations_ok())


def derive_durations(df: DataFrame) -> DataFrame:
    """Duration in minutes and hours (doubles)."""
    return df.withColumns(
        {
            "trip_duration_min": duration_minutes("trip_duration"),
            "trip_duration_hr": duration_hours("trip_duration"),
        }
    )


def derive_speed(df: DataFrame) -> DataFrame:
    """P3 + P4: ``avg_speed_mph = distance / hours`` with a zero duration
    giving NULL (not an ANSI error) and +inf replaced by NULL."""
    return df.withColumn(
        "avg_speed_mph", finite_or_null(speed_mph("trip_distance", "trip_duration_hr"))
    )


def drop_missing_speed(df: DataFrame) -> DataFrame:
    """drop rows whose speed is NULL or NaN."""
    return df.na.drop(subset=["avg_speed_mph"])


def filter_speed(df: DataFrame, lo: float = MIN_SPEED, hi: float = MAX_SPEED) -> DataFrame:
    """``lo < avg_speed_mph < hi``."""
    return df.filter(speed_ok(F.col("avg_speed_mph"), lo, hi))


def silver_projection(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """P5: the ordered silver columns that exist in ``df``."""
    wanted = SILVER_COLUMNS if columns is None else columns
    return df.select(*[c for c in wanted if c in df.columns])


def clean_trips(raw: DataFrame) -> DataFrame:
    """raw trips -> silver trips (one fused filter/project stage)."""
    return (
        raw.transform(check_raw_columns)
        .transform(filter_distance)
        .transform(filter_duration)
        .transform(filter_total_amount)
        .transform(filter_locations)
        .transform(derive_durations)
        .transform(derive_speed)
        .transform(drop_missing_speed)
        .transform(filter_speed)
        .transform(silver_projection)
    )


def cleaning_funnel(raw: DataFrame) -> DataFrame:
    """I4: rows surviving each cumulative cleaning stage, in ONE scan.

    Columns: ``raw_rows, after_distance, after_duration, after_amount,
    after_locations, after_speed_present, silver_rows``. Each is a
    ``count_if`` of the conjunction of the stage predicates so far; a NULL
    predicate does not count, exactly like a filter.
    """
    speed = _speed_expr()
    s1 = distance_ok()
    s2 = s1 & duration_ok()
    s3 = s2 & amount_ok() if "total_amount" in raw.columns else s2
    s4 = s3 & locations_ok()
    s5 = s4 & speed_present(speed)
    s6 = s5 & speed_ok(speed)
    return raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(s1).alias("after_distance"),
        F.count_if(s2).alias("after_duration"),
        F.count_if(s3).alias("after_amount"),
        F.count_if(s4).alias("after_locations"),
        F.count_if(s5).alias("after_speed_present"),
        F.count_if(s6).alias("silver_rows"),
    )


def speed_sanity(silver: DataFrame, n: int = 10) -> DataFrame:
    """A deterministic sample of distance / minutes / speed (the
    ``n`` fastest trips, ties by the other columns)."""
    return (
        silver.select("trip_distance", "trip_duration_min", "avg_speed_mph")
        .orderBy(F.desc("avg_speed_mph"), F.desc("trip_distance"), "trip_duration_min")
        .limit(n)
    )
