"""Temporal and spatial demand aggregates over silver trips.

All of these are ``groupBy`` + ``count``: Spark aggregates map-side
(partial HashAggregate) before the shuffle, so even a zone or hour holding a
third of all trips sends one partial row per map task, and the shuffled data
is at most (map tasks x distinct keys) rows. Outputs are tiny (24 hours,
7 days, zones x 24 cells); only the trip scan is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.functions.calendar import label_weekdays, weekday_position

# Fixed value: the evening rush hours, inclusive at both ends.
RUSH_HOUR_START, RUSH_HOUR_END = 16, 19
TOP_ZONES = 20


def count_by(trips: DataFrame, *keys: str) -> DataFrame:
    """Trips per ``keys``. ``trips`` may be trips or counts of trips by finer
    keys (a ``trip_count`` column, for example ``zones.demand_cells``)."""
    counted = "trip_count" in trips.columns
    return trips.groupBy(*keys).agg((F.sum("trip_count") if counted else F.count(F.lit(1))).alias("trip_count"))


def hourly_demand(silver: DataFrame) -> DataFrame:
    """G1: trips per hour of day, sorted by hour."""
    return count_by(silver, "hour_of_day").orderBy("hour_of_day")


def dow_demand(silver: DataFrame) -> DataFrame:
    """Trips per weekday (0 = Mon), sorted."""
    return count_by(silver, "day_of_week").orderBy("day_of_week")


def hour_dow_heatmap(silver: DataFrame) -> DataFrame:
    """Trips per (weekday, hour); sparse — empty cells are absent."""
    return count_by(silver, "day_of_week", "hour_of_day")


def temporal_demand(silver: DataFrame) -> DataFrame:
    """G1, G2 and G3 from one scan: the trips are counted to at most 168
    (weekday, hour) cells, and only those are rolled up by grouping sets.

    ``grain`` is ``hour``, ``dow`` or ``dow_hour``; the key columns not in
    the grain are NULL."""
    return roll_up_temporal(hour_dow_heatmap(silver))


def roll_up_temporal(cells: DataFrame) -> DataFrame:
    """The three grains from counts by weekday and hour (or finer)."""
    grain = (
        F.when(F.grouping("day_of_week") == 1, F.lit("hour"))
        .when(F.grouping("hour_of_day") == 1, F.lit("dow"))
        .otherwise(F.lit("dow_hour"))
    )
    return (
        cells.groupBy("day_of_week", "hour_of_day")
        .agg(F.sum("trip_count").alias("trip_count"))
        .groupingSets(
            [["hour_of_day"], ["day_of_week"], ["day_of_week", "hour_of_day"]],
            "day_of_week",
            "hour_of_day",
        )
        .agg(F.sum("trip_count").alias("trip_count"), grain.alias("grain"))
        .select("grain", "day_of_week", "hour_of_day", "trip_count")
    )


def top_pickup_zones(silver: DataFrame, n: int | None = TOP_ZONES) -> DataFrame:
    """The ``n`` busiest pickup zones (all zones when ``n`` is
    None). Ties on ``trip_count`` are broken by the lower zone id so the
    cut is deterministic; ``orderBy + limit`` plans as a top-k
    (TakeOrderedAndProject), never a full sort."""
    ranked = count_by(silver, "pickup_location_id").orderBy(
        F.desc("trip_count"), F.asc("pickup_location_id")
    )
    return ranked if n is None else ranked.limit(n)


def rush_hour_trips(
    silver: DataFrame, start: int = RUSH_HOUR_START, end: int = RUSH_HOUR_END
) -> DataFrame:
    """trips with ``start <= hour_of_day <= end``."""
    return silver.filter(F.col("hour_of_day").between(start, end))


def rush_hour_hotspots(silver: DataFrame, n: int | None = TOP_ZONES) -> DataFrame:
    """Top zones by trips during the rush hours."""
    return top_pickup_zones(rush_hour_trips(silver), n)


def hourly_zone_demand(silver: DataFrame) -> DataFrame:
    """Trips per (pickup zone, hour of day) — the alert grain."""
    return count_by(silver, "pickup_location_id", "hour_of_day")


def dow_demand_named(silver: DataFrame) -> DataFrame:
    """Trips per weekday label, ordered Mon..Sun; an unmapped weekday
    becomes a NULL label and sorts first."""
    return label_weekdays(count_by(silver, "day_of_week"), "trip_count").orderBy(weekday_position())


def heatmap_named(silver: DataFrame) -> DataFrame:
    """Trips per (weekday label, hour)."""
    return label_weekdays(hour_dow_heatmap(silver), "trip_count", "hour_of_day")


def hourly_per_day(silver: DataFrame) -> DataFrame:
    """Trips per calendar day and hour."""
    return count_by(silver, "year", "month", "day", "hour_of_day")


def hourly_avg_demand(silver: DataFrame) -> DataFrame:
    """Mean trips per hour of day over the days that had at least one
    trip in that hour (not over all calendar days). Two aggregations; the
    second runs on at most days x 24 rows."""
    return (
        hourly_per_day(silver)
        .groupBy("hour_of_day")
        .agg(F.avg("trip_count").alias("avg_trips_per_hour"))
        .orderBy("hour_of_day")
    )


def monthly_demand(silver: DataFrame) -> DataFrame:
    """Trips per (year, month), sorted."""
    return count_by(silver, "year", "month").orderBy("year", "month")
