"""Zone-level features and zone naming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.operators.demand import TOP_ZONES, top_pickup_zones
from zonepulse.plans.joins import bounded_lookup, dimension_join

# The zone feature columns, in model order; each mean with the
# trip column it averages.
ZONE_MEANS = {
    "avg_trip_distance": "trip_distance",
    "avg_fare_amount": "fare_amount",
    "avg_tip_amount": "tip_amount",
    "avg_speed": "avg_speed_mph",
    "avg_duration_min": "trip_duration_min",
}
FEATURE_COLUMNS = ["total_trips", *ZONE_MEANS]
GOLD_COLUMNS = [
    "pickup_location_id",
    "zone_name",
    "borough",
    "prediction",
    *FEATURE_COLUMNS,
]


def demand_cells(silver: DataFrame) -> DataFrame:
    """Trips by (zone, weekday, hour) with the sum and the number of values of
    every averaged measure: at most 168 rows per zone, from one scan. All
    demand counts, the zone features, the alerts and the cluster views can be
    made from it instead of from the trips."""
    sums = [
        f(source).alias(f"{kind}_{name}") for name, source in ZONE_MEANS.items() for kind, f in (("sum", F.sum), ("n", F.count))
    ]
    return silver.groupBy("pickup_location_id", "day_of_week", "hour_of_day").agg(
        F.count(F.lit(1)).alias("trip_count"), *sums
    )


def zone_features(silver: DataFrame) -> DataFrame:
    """One row per pickup zone: trip count and mean trip measures
    (NULLs do not count). Partial aggregation keeps a hot zone cheap.
    ``silver`` may be the trips or their ``demand_cells``."""
    if "trip_count" in silver.columns:
        total = F.sum("trip_count")
        means = {n: F.try_divide(F.sum(f"sum_{n}"), F.sum(f"n_{n}")) for n in ZONE_MEANS}
    else:
        total = F.count(F.lit(1))
        means = {n: F.avg(source) for n, source in ZONE_MEANS.items()}
    return silver.groupBy("pickup_location_id").agg(
        total.alias("total_trips"), *[mean.alias(n) for n, mean in means.items()]
    )


def zone_count(zone_frame: DataFrame) -> DataFrame:
    """Number of zones."""
    return zone_frame.agg(F.count(F.lit(1)).alias("zones"))


def unique_zones(zones: DataFrame) -> DataFrame:
    """Enforce one row per ``zone_id`` deterministically (trap: a duplicated
    dimension key would duplicate gold rows and double-count trips): the
    smallest (name, borough), where a row with a name beats one without."""
    ranked = F.struct(
        F.col("zone_name").isNull().alias("unnamed"), "zone_name", F.col("borough").isNull().alias("unplaced"), "borough"
    )
    return zones.groupBy("zone_id").agg(F.min(ranked).alias("_z")).select("zone_id", "_z.zone_name", "_z.borough")


def attach_zone_names(df: DataFrame, zones: DataFrame, key: str = "pickup_location_id") -> DataFrame:
    """LEFT JOIN the zone dimension on ``key = zone_id``; zones without
    a dimension row keep NULL ``zone_name``/``borough``. ``zones`` must be
    unique on ``zone_id`` (see ``unique_zones``)."""
    # df has one row per zone, so no key can be hot.
    return dimension_join(
        df, zones.select("zone_id", "zone_name", "borough"), key, "zone_id", "left", few_rows_per_key=True
    )


def gold_projection(df: DataFrame) -> DataFrame:
    """The gold column list."""
    return df.select(*GOLD_COLUMNS)


def top_zones_named(silver: DataFrame, zones: DataFrame, n: int | None = TOP_ZONES) -> DataFrame:
    """The busiest ``n`` zones (all zones when ``n`` is None) with
    their names, busiest first (ties by zone id). ``zones`` may repeat ids."""
    top = top_pickup_zones(silver, n)
    dim = zones.select("zone_id", "zone_name", "borough")
    if n is not None:
        named = bounded_lookup(top, dim, "pickup_location_id", "zone_id", unique=unique_zones)
    else:
        named = attach_zone_names(top, unique_zones(dim))
    return named.select("pickup_location_id", "zone_name", "borough", "trip_count").orderBy(
        F.desc("trip_count"), F.asc("pickup_location_id")
    )
