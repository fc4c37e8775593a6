"""Cluster insights over gold zones (+ silver trips): summaries, hotspots,
alerts, recommendations, and the per-cluster demand views.

Gold holds one row per zone with its cluster ``prediction``. Operators that
combine trips with clusters aggregate the trips to (zone, hour[, weekday])
FIRST and join the cluster id afterwards: the join then sees at most
zones x 24 (x 7) rows with unique keys, so a zone holding a third of all
trips costs nothing extra and the cluster side never needs broadcasting
at trip volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.functions.quantiles import percentile_disc, threshold_frame, threshold_value
from zonepulse.operators.demand import count_by, hourly_zone_demand
from zonepulse.plans.joins import dimension_join

# Quantiles and the default cluster of the reference's
# hotspot views.
HOTSPOT_QUANTILE = 0.75
ALERT_QUANTILE = 0.90
DEFAULT_CLUSTER = 0


def cluster_summary(gold: DataFrame) -> DataFrame:
    """Per cluster: zones, trips, and UNWEIGHTED means of zone means."""
    return (
        gold.groupBy("prediction")
        .agg(
            F.count(F.lit(1)).alias("num_zones"),
            F.sum("total_trips").alias("total_trips_cluster"),
            F.avg("avg_trip_distance").alias("avg_distance"),
            F.avg("avg_fare_amount").alias("avg_fare"),
            F.avg("avg_tip_amount").alias("avg_tip"),
            F.avg("avg_speed").alias("avg_speed"),
            F.avg("avg_duration_min").alias("avg_duration_min"),
        )
        .orderBy("prediction")
    )


def cluster_summary_chart(gold: DataFrame) -> DataFrame:
    """G8 without the zone count."""
    return cluster_summary(gold).drop("num_zones")


def zones_by_cluster(gold: DataFrame) -> DataFrame:
    """T5 / P10: every zone, by cluster, busiest first within a cluster (ties
    by zone id)."""
    return gold.orderBy("prediction", F.desc("total_trips"), "pickup_location_id").select(
        "prediction", "zone_name", "borough", "total_trips"
    )


def trips_threshold(gold: DataFrame, q: float = HOTSPOT_QUANTILE, relative_error: float = 0.0) -> DataFrame:
    """Discrete ``q``-quantile of zone trip totals over ALL zones (one
    row; NULL when gold is empty). Exact by default; ``relative_error=0.01``
    gives the approximate variant."""
    return threshold_frame(gold, "total_trips", q, "trips_threshold", relative_error)


def hotspots(
    gold: DataFrame, cluster: int = DEFAULT_CLUSTER, q: float = HOTSPOT_QUANTILE, relative_error: float = 0.0
) -> DataFrame:
    """Zones of ``cluster`` with ``total_trips >=`` the all-zone
    ``q``-quantile (inclusive), busiest first."""
    limit = threshold_value(gold, "total_trips", q, relative_error)
    return gold.filter(
        (F.col("prediction") == F.lit(cluster)) & (F.col("total_trips") >= limit)
    ).orderBy(F.desc("total_trips"), "pickup_location_id")


def cluster_keys(gold: DataFrame) -> DataFrame:
    """(zone, cluster) pairs."""
    return gold.select("pickup_location_id", "prediction")


def trips_with_cluster(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Every silver trip with its zone's cluster (NULL when the zone is
    not in gold). Trip-sized output; the cluster side is broadcast only
    when its size is checked small, otherwise hot zones are salted."""
    return dimension_join(silver, cluster_keys(gold), "pickup_location_id", how="left")


def _zone_cells(silver: DataFrame, *keys: str) -> DataFrame:
    return count_by(silver, "pickup_location_id", *keys)


def _cells_with_cluster(silver: DataFrame, gold: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    cells = _zone_cells(silver, *keys)
    # Cells have at most 168 rows per zone, so no key can be hot.
    return dimension_join(cells, cluster_keys(gold), "pickup_location_id", how=how, few_rows_per_key=True)


def cluster_hourly_demand(silver: DataFrame, gold: DataFrame, cluster: int = DEFAULT_CLUSTER) -> DataFrame:
    """Trips per hour of day in the zones of ``cluster`` (all hours,
    no rush-hour filter)."""
    members = cluster_keys(gold).filter(F.col("prediction") == F.lit(cluster))
    cells = _zone_cells(silver, "hour_of_day")
    return (
        dimension_join(cells, members, "pickup_location_id", how="inner", few_rows_per_key=True)
        .groupBy("hour_of_day")
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy("hour_of_day")
    )


def demand_threshold(silver: DataFrame, q: float = ALERT_QUANTILE) -> DataFrame:
    """Exact discrete ``q``-quantile of (zone, hour) trip counts."""
    return threshold_frame(hourly_zone_demand(silver), "trip_count", q, "demand_threshold")


def demand_alerts(silver: DataFrame, q: float = ALERT_QUANTILE) -> DataFrame:
    """T4: (zone, hour) cells with ``trip_count >=`` the ``q``-quantile of
    all cells (ties included), busiest first. The cell frame is computed
    once; Spark reuses its shuffle for the threshold subquery."""
    cells = hourly_zone_demand(silver)
    limit = threshold_value(cells, "trip_count", q)
    return cells.filter(F.col("trip_count") >= limit).orderBy(
        F.desc("trip_count"), "pickup_location_id", "hour_of_day"
    )


def recommendations(gold: DataFrame) -> DataFrame:
    """The recommendation table, busiest zones first (ties by zone
    id). Fixed values: the output columns."""
    return gold.orderBy(F.desc("total_trips"), "pickup_location_id").select(
        "zone_name", "borough", "prediction", "total_trips", "avg_fare_amount", "avg_duration_min"
    )


def top_zones_per_cluster(gold: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` busiest zones of every cluster (ties by zone id).

    ``row_number() <= n`` lets Spark insert a partial per-group limit before
    the shuffle, so a cluster holding most zones still ships only ``n`` rows
    per map task."""
    w = Window.partitionBy("prediction").orderBy(F.desc("total_trips"), F.asc("pickup_location_id"))
    return (
        gold.withColumn("zone_rank", F.row_number().over(w))
        .filter(F.col("zone_rank") <= F.lit(n))
        .select("prediction", "zone_rank", "pickup_location_id", "zone_name", "borough", "total_trips")
    )


# Demand tiers by a cluster's mean trips per zone relative to
# all zones, and the advice code attached to each tier.
TIER_HIGH, TIER_MODERATE, TIER_BASELINE = "high_demand", "moderate_demand", "baseline"
ADVICE = [
    (TIER_HIGH, "dedicated_fleet", "dense all-day coverage, staff the peak hours"),
    (TIER_MODERATE, "balanced_coverage", "balanced coverage, add cars in the peak hours"),
    (TIER_BASELINE, "baseline_coverage", "baseline coverage with overflow from nearby zones"),
]


def cluster_roles(gold: DataFrame) -> DataFrame:
    """Give clusters a meaning from data instead of eyeballed ids.

    ``demand_rank`` 1 = highest mean trips per zone. ``demand_tier``
    compares the cluster mean with the all-zone quartiles of
    ``total_trips`` (>= p75 high, < p50 baseline, else moderate).
    ``long_trips`` flags clusters whose mean distance exceeds the all-zone
    mean. Works on K rows after one aggregation of gold.
    """
    stats = gold.agg(
        percentile_disc("total_trips", 0.75).alias("_p75"),
        percentile_disc("total_trips", 0.5).alias("_p50"),
        F.avg("avg_trip_distance").alias("_dist"),
    )
    per_cluster = gold.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("num_zones"),
        F.avg("total_trips").alias("mean_trips_per_zone"),
        F.avg("avg_trip_distance").alias("mean_distance"),
    )
    # One struct-valued scalar subquery, referenced three times: Spark runs
    # it once (identical subqueries are reused).
    row = stats.select(F.struct("_p75", "_p50", "_dist").alias("s")).scalar()
    p75, p50, dist = row.getField("_p75"), row.getField("_p50"), row.getField("_dist")
    # per_cluster has K rows, so this single-partition window is bounded by K
    rank = F.dense_rank().over(Window.orderBy(F.desc("mean_trips_per_zone")))
    tier = (
        F.when(F.col("mean_trips_per_zone") >= p75, F.lit(TIER_HIGH))
        .when(F.col("mean_trips_per_zone") < p50, F.lit(TIER_BASELINE))
        .otherwise(F.lit(TIER_MODERATE))
    )
    return per_cluster.select(
        "prediction",
        "num_zones",
        "mean_trips_per_zone",
        "mean_distance",
        rank.alias("demand_rank"),
        tier.alias("demand_tier"),
        (F.col("mean_distance") > dist).alias("long_trips"),
    )


def _peak_hours(cells: DataFrame, top: int) -> DataFrame:
    hourly = cells.groupBy("prediction", "hour_of_day").agg(F.sum("trip_count").alias("trip_count"))
    # At most K x 24 rows: each per-cluster window holds 24 rows.
    per_cluster = Window.partitionBy("prediction")
    ranked = hourly.select(
        "prediction",
        "hour_of_day",
        "trip_count",
        (F.col("trip_count") / F.sum("trip_count").over(per_cluster)).alias("trip_share"),
        F.dense_rank().over(per_cluster.orderBy(F.desc("trip_count"))).alias("hour_rank"),
    )
    return ranked.filter(F.col("hour_rank") <= F.lit(top))


def cluster_peak_hours(silver: DataFrame, gold: DataFrame, top: int = 3) -> DataFrame:
    """Per cluster, its ``top`` busiest hours (dense rank, ties kept)
    and each hour's share of the cluster's trips."""
    return _peak_hours(_cells_with_cluster(silver, gold, "hour_of_day"), top)


# Day parts, hours inclusive; weekend = weekday 5 and 6.
MORNING_RUSH = (7, 9)
EVENING_RUSH = (16, 19)
NIGHT_FROM, NIGHT_TO = 22, 5
WEEKEND_FROM = 5


def _dayparts(cells: DataFrame) -> DataFrame:
    hour, dow, n = F.col("hour_of_day"), F.col("day_of_week"), F.col("trip_count")

    def share(cond):
        return F.sum(F.when(cond, n).otherwise(F.lit(0))) / F.sum(n)

    return cells.groupBy("prediction").agg(
        F.sum(n).alias("trips"),
        share(dow >= F.lit(WEEKEND_FROM)).alias("weekend_share"),
        share(hour.between(*MORNING_RUSH)).alias("morning_rush_share"),
        share(hour.between(*EVENING_RUSH)).alias("evening_rush_share"),
        share((hour >= F.lit(NIGHT_FROM)) | (hour <= F.lit(NIGHT_TO))).alias("night_share"),
    )


def cluster_daypart_share(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Per cluster, share of trips on weekends, in the morning and
    evening rush and at night."""
    cells = _cells_with_cluster(silver, gold, "day_of_week", "hour_of_day")
    return _dayparts(cells).orderBy("prediction")


def advice_table(spark) -> DataFrame:
    """The fixed tier -> advice mapping as a (3-row) DataFrame."""
    return spark.createDataFrame(ADVICE, "demand_tier string, advice_code string, advice string")


def cluster_recommendations(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Per cluster: role (R8), advice for the role, its busiest hour
    (R10) and day-part shares (R11)."""
    spark = gold.sparkSession
    roles = cluster_roles(gold)
    # One aggregation of the trips to (zone, weekday, hour), summed once to
    # at most K x 168 rows that feed the peak hour and the day-part shares.
    cells = _cells_with_cluster(silver, gold, "day_of_week", "hour_of_day")
    cells = cells.groupBy("prediction", "day_of_week", "hour_of_day").agg(F.sum("trip_count").alias("trip_count"))
    peak = _peak_hours(cells, 1).groupBy("prediction").agg(F.min("hour_of_day").alias("peak_hour"))
    parts = _dayparts(cells).select("prediction", "weekend_share", "evening_rush_share")
    # Every input here has one row per cluster (K rows), so the joins are
    # broadcast by construction; the advice table has three rows.
    return (
        roles.join(F.broadcast(advice_table(spark)), "demand_tier", "left")
        .join(F.broadcast(peak), "prediction", "left")
        .join(F.broadcast(parts), "prediction", "left")
        .select(
            "prediction",
            "demand_rank",
            "demand_tier",
            "long_trips",
            "num_zones",
            "advice_code",
            "advice",
            "peak_hour",
            "weekend_share",
            "evening_rush_share",
        )
        .orderBy("demand_rank", "prediction")
    )
