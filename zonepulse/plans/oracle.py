"""Independent SQL (DuckDB dialect) for every SQL-expressible query of the
registry, over the raw test tables. Used only for verification.

Rules: decimal literals are cast to DOUBLE (a bare ``60.0`` is DECIMAL),
counts are cast to BIGINT, calendar parts to INTEGER, aggregate doubles are
rounded to 6 decimals like the Spark side, and per-row doubles are left
exact (both engines perform the same IEEE operations).
"""

from __future__ import annotations

RAW_B = """raw AS (
  SELECT l_orderkey AS trip_id,
         l_quantity AS trip_distance,
         CAST(30 + (l_orderkey * 37 + l_partkey * 11 + l_linenumber * 101) % 15000 AS BIGINT) AS trip_duration,
         l_suppkey AS pickup_location_id,
         l_partkey AS dropoff_location_id,
         CAST(year(l_shipdate) AS INTEGER) AS "year",
         CAST(month(l_shipdate) AS INTEGER) AS "month",
         CAST(day(l_shipdate) AS INTEGER) AS "day",
         CAST(isodow(l_shipdate) - 1 AS INTEGER) AS day_of_week,
         CAST((l_orderkey + l_linenumber) % 24 AS INTEGER) AS hour_of_day,
         l_extendedprice / 1000 AS fare_amount,
         l_extendedprice / 1000 * l_discount AS tip_amount,
         l_extendedprice / 1000 * (1 + l_discount + l_tax) AS total_amount
  FROM lineitem)"""

RAW_A = """raw AS (
  SELECT event_id AS trip_id,
         value AS trip_distance,
         CAST(date_diff('second', ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS BIGINT)
           AS trip_duration,
         user_id AS pickup_location_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS dropoff_location_id,
         CAST(year(ts) AS INTEGER) AS "year",
         CAST(month(ts) AS INTEGER) AS "month",
         CAST(day(ts) AS INTEGER) AS "day",
         CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
         CAST(hour(ts) AS INTEGER) AS hour_of_day,
         value AS fare_amount,
         CAST(json_extract_string(props, '$.k') AS BIGINT) / 10 AS tip_amount,
         value + CAST(json_extract_string(props, '$.k') AS BIGINT) / 10 AS total_amount
  FROM events)"""

P_DIST = "trip_distance > 0 AND trip_distance < 100"
P_DUR = "trip_duration > 60 AND trip_duration < 14400"
P_AMT = "total_amount > 0"
P_LOC = (
    "pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL "
    "AND pickup_location_id > 0 AND dropoff_location_id > 0"
)
SPEED = "trip_distance / (trip_duration / CAST(3600.0 AS DOUBLE))"
SPEED_FINITE = f"CASE WHEN {SPEED} = CAST('inf' AS DOUBLE) THEN NULL ELSE {SPEED} END"
P_SPEED_PRESENT = "{s} IS NOT NULL AND NOT isnan({s})"
P_SPEED = "{s} > 0 AND {s} < 80"

DERIVED_COLS = (
    "trip_duration / CAST(60.0 AS DOUBLE) AS trip_duration_min, "
    "trip_duration / CAST(3600.0 AS DOUBLE) AS trip_duration_hr, "
    f"{SPEED_FINITE} AS avg_speed_mph"
)

SILVER_COLS = (
    'trip_distance, pickup_location_id, dropoff_location_id, "year", "month", "day", '
    "day_of_week, hour_of_day, trip_duration_min, avg_speed_mph, fare_amount, tip_amount, total_amount"
)

DERIVED = f"""derived AS (
  SELECT *, {DERIVED_COLS}
  FROM raw
  WHERE {P_DIST} AND {P_DUR} AND {P_AMT} AND {P_LOC})"""

SILVER = f"""silver AS (
  SELECT {SILVER_COLS}
  FROM derived
  WHERE {P_SPEED_PRESENT.format(s='avg_speed_mph')} AND {P_SPEED.format(s='avg_speed_mph')})"""

ZONES = """zones AS (
  SELECT s_suppkey AS zone_id, s_name AS zone_name, n_name AS borough
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""

ZF = """zf AS (
  SELECT pickup_location_id,
         count(*) AS total_trips,
         avg(trip_distance) AS avg_trip_distance,
         avg(fare_amount) AS avg_fare_amount,
         avg(tip_amount) AS avg_tip_amount,
         avg(avg_speed_mph) AS avg_speed,
         avg(trip_duration_min) AS avg_duration_min
  FROM silver GROUP BY pickup_location_id)"""

GOLD = """span AS (SELECT max(total_trips) AS hi, min(total_trips) AS lo FROM zf),
gold AS (
  SELECT zf.pickup_location_id, z.zone_name, z.borough,
         COALESCE(LEAST(CAST(floor(CAST((SELECT hi FROM span) - zf.total_trips AS DOUBLE)
                  / CAST(NULLIF((SELECT hi FROM span) - (SELECT lo FROM span), 0) AS DOUBLE) * 5.0) AS INTEGER), 4), 0)
           AS prediction,
         zf.total_trips, zf.avg_trip_distance, zf.avg_fare_amount, zf.avg_tip_amount,
         zf.avg_speed, zf.avg_duration_min
  FROM zf LEFT JOIN zones z ON zf.pickup_location_id = z.zone_id)"""

CELLS = """cells AS (
  SELECT pickup_location_id, hour_of_day, count(*) AS trip_count
  FROM silver GROUP BY pickup_location_id, hour_of_day)"""

FEATURES = [
    "total_trips",
    "avg_trip_distance",
    "avg_fare_amount",
    "avg_tip_amount",
    "avg_speed",
    "avg_duration_min",
]


def r(expr: str, alias: str | None = None) -> str:
    return f"ROUND({expr}, 6) AS {alias or expr}"


GOLD_SELECT = (
    "pickup_location_id, zone_name, borough, prediction, total_trips, "
    + ", ".join(r(c) for c in FEATURES[1:])
)
ZF_SELECT = "pickup_location_id, total_trips, " + ", ".join(r(c) for c in FEATURES[1:])


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SB = with_(RAW_B, DERIVED, SILVER)  # silver, fixture B
SA = with_(RAW_A, DERIVED, SILVER)  # silver, fixture A
GB = with_(RAW_B, DERIVED, SILVER, ZONES, ZF, GOLD)  # demand-band gold, fixture B

DAY_NAME = (
    "CASE day_of_week WHEN 0 THEN 'Mon' WHEN 1 THEN 'Tue' WHEN 2 THEN 'Wed' WHEN 3 THEN 'Thu' "
    "WHEN 4 THEN 'Fri' WHEN 5 THEN 'Sat' WHEN 6 THEN 'Sun' END"
)


def _funnel(raw_cte: str) -> str:
    s = "spd"
    s1 = P_DIST
    s2 = f"{s1} AND {P_DUR}"
    s3 = f"{s2} AND {P_AMT}"
    s4 = f"{s3} AND {P_LOC}"
    s5 = f"{s4} AND {P_SPEED_PRESENT.format(s=s)}"
    s6 = f"{s5} AND {P_SPEED.format(s=s)}"
    stages = [s1, s2, s3, s4, s5, s6]
    names = ["after_distance", "after_duration", "after_amount", "after_locations", "after_speed_present", "silver_rows"]
    cols = ",\n  ".join(f"CAST(count_if({p}) AS BIGINT) AS {n}" for p, n in zip(stages, names))
    return (
        with_(raw_cte, f"s AS (SELECT *, {SPEED_FINITE} AS spd FROM raw)")
        + f"SELECT CAST(count(*) AS BIGINT) AS raw_rows,\n  {cols}\nFROM s"
    )


def _top(silver_prefix: str, n: int | None, where: str = "") -> str:
    limit = f" LIMIT {n}" if n is not None else ""
    return (
        silver_prefix
        + f"SELECT pickup_location_id, count(*) AS trip_count FROM silver {where} "
        + f"GROUP BY pickup_location_id ORDER BY trip_count DESC, pickup_location_id{limit}"
    )


def _top_named(raw_cte: str, n: int | None) -> str:
    limit = f" LIMIT {n}" if n is not None else ""
    return with_(
        raw_cte,
        DERIVED,
        SILVER,
        ZONES,
        "t AS (SELECT pickup_location_id, count(*) AS trip_count FROM silver GROUP BY pickup_location_id "
        f"ORDER BY trip_count DESC, pickup_location_id{limit})",
    ) + (
        "SELECT t.pickup_location_id, z.zone_name, z.borough, t.trip_count "
        "FROM t LEFT JOIN zones z ON t.pickup_location_id = z.zone_id"
    )


def _alerts(prefix: str) -> str:
    return (
        prefix.rstrip() + ",\n" + CELLS + "\n"
        "SELECT pickup_location_id, hour_of_day, trip_count FROM cells "
        "WHERE trip_count >= (SELECT quantile_disc(trip_count, 0.9) FROM cells)"
    )


ROLES = """stats AS (
  SELECT quantile_disc(total_trips, 0.75) AS p75, quantile_disc(total_trips, 0.5) AS p50,
         avg(avg_trip_distance) AS dist FROM gold),
pc AS (
  SELECT prediction, count(*) AS num_zones, avg(total_trips) AS mean_trips_per_zone,
         avg(avg_trip_distance) AS mean_distance FROM gold GROUP BY prediction),
roles AS (
  SELECT prediction, num_zones, mean_trips_per_zone, mean_distance,
         CAST(dense_rank() OVER (ORDER BY mean_trips_per_zone DESC) AS INTEGER) AS demand_rank,
         CASE WHEN mean_trips_per_zone >= (SELECT p75 FROM stats) THEN 'high_demand'
              WHEN mean_trips_per_zone < (SELECT p50 FROM stats) THEN 'baseline'
              ELSE 'moderate_demand' END AS demand_tier,
         mean_distance > (SELECT dist FROM stats) AS long_trips
  FROM pc)"""

PEAK = """h AS (
  SELECT prediction, hour_of_day, count(*) AS trip_count
  FROM silver JOIN gold USING (pickup_location_id) GROUP BY prediction, hour_of_day),
peak AS (
  SELECT prediction, hour_of_day, trip_count,
         trip_count / sum(trip_count) OVER (PARTITION BY prediction) AS trip_share,
         dense_rank() OVER (PARTITION BY prediction ORDER BY trip_count DESC) AS hour_rank
  FROM h)"""

DAYPART = """dp AS (
  SELECT prediction, count(*) AS trips,
         count_if(day_of_week >= 5) / count(*) AS weekend_share,
         count_if(hour_of_day BETWEEN 7 AND 9) / count(*) AS morning_rush_share,
         count_if(hour_of_day BETWEEN 16 AND 19) / count(*) AS evening_rush_share,
         count_if(hour_of_day >= 22 OR hour_of_day <= 5) / count(*) AS night_share
  FROM silver JOIN gold USING (pickup_location_id) GROUP BY prediction)"""

ADVICE = """advice AS (
  SELECT * FROM (VALUES
    ('high_demand', 'dedicated_fleet', 'dense all-day coverage, staff the peak hours'),
    ('moderate_demand', 'balanced_coverage', 'balanced coverage, add cars in the peak hours'),
    ('baseline', 'baseline_coverage', 'baseline coverage with overflow from nearby zones'))
    AS t(demand_tier, advice_code, advice))"""

RAW_COLUMNS = [
    ("trip_id", "bigint"),
    ("trip_distance", "double"),
    ("trip_duration", "bigint"),
    ("pickup_location_id", "bigint"),
    ("dropoff_location_id", "bigint"),
    ("year", "int"),
    ("month", "int"),
    ("day", "int"),
    ("day_of_week", "int"),
    ("hour_of_day", "int"),
    ("fare_amount", "double"),
    ("tip_amount", "double"),
    ("total_amount", "double"),
]


def _profile() -> str:
    parts = []
    for name, typ in RAW_COLUMNS:
        c = f'"{name}"'
        nans = f"count_if(isnan({c}))" if typ == "double" else "0"
        parts.append(
            f"SELECT '{name}' AS \"column\", '{typ}' AS data_type, CAST(count(*) AS BIGINT) AS \"rows\", "
            f"CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, CAST({nans} AS BIGINT) AS nans, "
            f'CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max", '
            f"ROUND(avg({c}), 6) AS mean, ROUND(stddev_samp({c}), 6) AS stddev FROM raw"
        )
    return with_(RAW_B) + "\nUNION ALL\n".join(parts)


def _correlation() -> str:
    parts = []
    for i, a in enumerate(FEATURES):
        for b in FEATURES[i + 1:]:
            parts.append(f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", ROUND(corr({a}, {b}), 6) AS corr FROM zf")
    return with_(RAW_B, DERIVED, SILVER, ZF) + "\nUNION ALL\n".join(parts)


RANKED = ("trip_distance", "trip_duration_min", "fare_amount", "tip_amount", "avg_speed_mph")


def _rank_correlation() -> str:
    """Mean ranks: the rank of a value plus half of its further occurrences."""
    there = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in RANKED)
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / CAST(2.0 AS DOUBLE) AS {c}" for c in RANKED
    )
    parts = [
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", ROUND(corr({a}, {b}), 6) AS corr FROM ranked"
        for i, a in enumerate(RANKED)
        for b in RANKED[i + 1:]
    ]
    return SB.rstrip() + f",\nranked AS (SELECT {ranks} FROM silver WHERE {there})\n" + "\nUNION ALL\n".join(parts)


# What any sketch within its bound gives.
SKETCHED_QUANTILES = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS measure, quantile, count({c}) AS n, true AS within_bound "
    "FROM silver, (SELECT unnest([0.5, 0.75, 0.9])::DOUBLE AS quantile) GROUP BY quantile"
    for c in ("trip_distance", "trip_duration_min", "fare_amount")
)
SKETCHED_DISTINCT = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS key, count(DISTINCT {c}) AS exact, true AS within_bound FROM silver"
    for c in ("pickup_location_id", "dropoff_location_id")
)

WINDOW_ALERTS = """WITH c AS (
  SELECT user_id AS pickup_location_id, date_trunc('hour', ts) AS window_start, count(*) AS trip_count
  FROM events WHERE user_id IS NOT NULL AND user_id > 0
  GROUP BY 1, 2)
SELECT pickup_location_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, trip_count
FROM c WHERE trip_count >= (SELECT quantile_disc(trip_count, 0.9) FROM c)"""


# Gaps and islands: consecutive hours less their number are one value.
ALERT_EPISODES = f"""WITH a AS ({WINDOW_ALERTS}),
i AS (
  SELECT *, window_start - row_number() OVER (PARTITION BY pickup_location_id ORDER BY window_start) * INTERVAL 1 HOUR AS island
  FROM a)
SELECT pickup_location_id, min(window_start) AS episode_start, max(window_end) AS episode_end,
       count(*) AS hours, max(trip_count) AS peak
FROM i GROUP BY pickup_location_id, island"""


ORACLE_SQL: dict[str, str] = {
    # sources and sinks
    "scan_raw": with_(RAW_B) + "SELECT * FROM raw",
    "scan_zones": with_(ZONES) + "SELECT * FROM zones",
    "write_silver": SB + "SELECT * FROM silver",
    "bronze_clone": "SELECT * FROM lineitem",
    "write_hourly_demand": SB + "SELECT hour_of_day, count(*) AS trip_count FROM silver GROUP BY hour_of_day",
    "write_dow_demand": SB + "SELECT day_of_week, count(*) AS trip_count FROM silver GROUP BY day_of_week",
    "write_gold": GB + f"SELECT {GOLD_SELECT} FROM gold",
    "write_recommendations": GB
    + "SELECT zone_name, borough, prediction, total_trips, "
    + r("avg_fare_amount")
    + ", "
    + r("avg_duration_min")
    + " FROM gold",
    # cleaning
    "clean_trips": SB + "SELECT * FROM silver",
    "clean_trips_events": SA + "SELECT * FROM silver",
    "cleaning_funnel": _funnel(RAW_B),
    "cleaning_funnel_events": _funnel(RAW_A),
    "filter_distance": with_(RAW_A) + f"SELECT * FROM raw WHERE {P_DIST}",
    "filter_duration": with_(RAW_A) + f"SELECT * FROM raw WHERE {P_DUR}",
    "filter_total_amount": with_(RAW_A) + f"SELECT * FROM raw WHERE {P_AMT}",
    "filter_locations": with_(RAW_A) + f"SELECT * FROM raw WHERE {P_LOC}",
    "derive_features": with_(RAW_B) + f"SELECT *, {DERIVED_COLS} FROM raw WHERE {P_DIST} AND {P_DUR} AND {P_AMT} AND {P_LOC}",
    "filter_speed": with_(RAW_A, f"d AS (SELECT *, {DERIVED_COLS} FROM raw)")
    + f"SELECT * FROM d WHERE {P_SPEED_PRESENT.format(s='avg_speed_mph')} AND {P_SPEED.format(s='avg_speed_mph')}",
    "speed_sanity": SB
    + "SELECT trip_distance, trip_duration_min, avg_speed_mph FROM silver "
    "ORDER BY avg_speed_mph DESC, trip_distance DESC, trip_duration_min LIMIT 10",
    # demand
    "hourly_demand": SB + "SELECT hour_of_day, count(*) AS trip_count FROM silver GROUP BY hour_of_day",
    "hourly_demand_events": SA + "SELECT hour_of_day, count(*) AS trip_count FROM silver GROUP BY hour_of_day",
    "dow_demand": SB + "SELECT day_of_week, count(*) AS trip_count FROM silver GROUP BY day_of_week",
    "hour_dow_heatmap": SB
    + "SELECT day_of_week, hour_of_day, count(*) AS trip_count FROM silver GROUP BY day_of_week, hour_of_day",
    "temporal_demand": SB
    + "SELECT CASE WHEN grouping(day_of_week) = 1 THEN 'hour' WHEN grouping(hour_of_day) = 1 THEN 'dow' "
    "ELSE 'dow_hour' END AS grain, day_of_week, hour_of_day, count(*) AS trip_count FROM silver "
    "GROUP BY GROUPING SETS ((hour_of_day), (day_of_week), (day_of_week, hour_of_day))",
    "top_pickup_zones": _top(SB, 20),
    "top_pickup_zones_events": _top(SA, 20),
    "top_zones_all": _top(SB, None),
    "rush_hour_trips": SB + "SELECT * FROM silver WHERE hour_of_day BETWEEN 16 AND 19",
    "rush_hour_hotspots": _top(SB, 20, "WHERE hour_of_day BETWEEN 16 AND 19"),
    "hourly_zone_demand": SB
    + "SELECT pickup_location_id, hour_of_day, count(*) AS trip_count FROM silver "
    "GROUP BY pickup_location_id, hour_of_day",
    "dow_demand_named": SB + f"SELECT {DAY_NAME} AS day_name, count(*) AS trip_count FROM silver GROUP BY 1",
    "heatmap_named": SB
    + f"SELECT {DAY_NAME} AS day_name, hour_of_day, count(*) AS trip_count FROM silver GROUP BY 1, 2",
    "hourly_per_day": SB
    + 'SELECT "year", "month", "day", hour_of_day, count(*) AS trip_count FROM silver '
    'GROUP BY "year", "month", "day", hour_of_day',
    "hourly_avg_demand": SB
    + 'SELECT hour_of_day, ROUND(avg(trip_count), 6) AS avg_trips_per_hour FROM ('
    'SELECT "year", "month", "day", hour_of_day, count(*) AS trip_count FROM silver '
    'GROUP BY "year", "month", "day", hour_of_day) GROUP BY hour_of_day',
    "hourly_avg_demand_events": SA
    + 'SELECT hour_of_day, ROUND(avg(trip_count), 6) AS avg_trips_per_hour FROM ('
    'SELECT "year", "month", "day", hour_of_day, count(*) AS trip_count FROM silver '
    'GROUP BY "year", "month", "day", hour_of_day) GROUP BY hour_of_day',
    "monthly_demand": SB + 'SELECT "year", "month", count(*) AS trip_count FROM silver GROUP BY "year", "month"',
    # zones
    "zone_features": with_(RAW_B, DERIVED, SILVER, ZF) + f"SELECT {ZF_SELECT} FROM zf",
    "refreshed_zone_features": with_(RAW_B, DERIVED, SILVER, ZF) + f"SELECT {ZF_SELECT} FROM zf",
    "refreshed_heatmap": SB
    + "SELECT day_of_week, hour_of_day, count(*) AS trip_count FROM silver GROUP BY day_of_week, hour_of_day",
    "zone_count": SB + "SELECT count(DISTINCT pickup_location_id) AS zones FROM silver",
    "zone_names": with_(RAW_A, DERIVED, SILVER, ZONES, ZF)
    + f"SELECT {ZF_SELECT}, z.zone_name, z.borough FROM zf LEFT JOIN zones z ON zf.pickup_location_id = z.zone_id",
    "top_zones_named": _top_named(RAW_B, 20),
    "top_zones_named_all": _top_named(RAW_B, None),
    "top_zones_named_events": _top_named(RAW_A, 20),
    # cluster insights, demand-band gold
    "gold_demand_bands": GB + f"SELECT {GOLD_SELECT} FROM gold",
    "cluster_keys": GB + "SELECT pickup_location_id, prediction FROM gold",
    "cluster_summary": GB
    + "SELECT prediction, count(*) AS num_zones, CAST(sum(total_trips) AS BIGINT) AS total_trips_cluster, "
    + ", ".join(
        r(f"avg({c})", a)
        for c, a in [
            ("avg_trip_distance", "avg_distance"),
            ("avg_fare_amount", "avg_fare"),
            ("avg_tip_amount", "avg_tip"),
            ("avg_speed", "avg_speed"),
            ("avg_duration_min", "avg_duration_min"),
        ]
    )
    + " FROM gold GROUP BY prediction",
    "cluster_summary_chart": GB
    + "SELECT prediction, CAST(sum(total_trips) AS BIGINT) AS total_trips_cluster, "
    + ", ".join(
        r(f"avg({c})", a)
        for c, a in [
            ("avg_trip_distance", "avg_distance"),
            ("avg_fare_amount", "avg_fare"),
            ("avg_tip_amount", "avg_tip"),
            ("avg_speed", "avg_speed"),
            ("avg_duration_min", "avg_duration_min"),
        ]
    )
    + " FROM gold GROUP BY prediction",
    "zones_by_cluster": GB + "SELECT prediction, zone_name, borough, total_trips FROM gold",
    "trips_threshold": GB + "SELECT quantile_disc(total_trips, 0.75) AS trips_threshold FROM gold",
    "hotspots": GB
    + f"SELECT {GOLD_SELECT} FROM gold WHERE prediction = 0 AND "
    "total_trips >= (SELECT quantile_disc(total_trips, 0.75) FROM gold)",
    "trips_with_cluster": GB
    + "SELECT silver.*, g.prediction FROM silver LEFT JOIN "
    "(SELECT pickup_location_id AS k, prediction FROM gold) g ON silver.pickup_location_id = g.k",
    "trips_with_cluster_bucketed": GB
    + "SELECT silver.*, g.prediction FROM silver LEFT JOIN "
    "(SELECT pickup_location_id AS k, prediction FROM gold) g ON silver.pickup_location_id = g.k",
    "cluster_hourly_demand": GB
    + "SELECT hour_of_day, count(*) AS trip_count FROM silver JOIN gold USING (pickup_location_id) "
    "WHERE prediction = 0 GROUP BY hour_of_day",
    "demand_threshold": SB.rstrip() + ",\n" + CELLS + "\nSELECT quantile_disc(trip_count, 0.9) AS demand_threshold FROM cells",
    "demand_alerts": _alerts(SB),
    "demand_alerts_events": _alerts(SA),
    "recommendations": GB
    + "SELECT zone_name, borough, prediction, total_trips, "
    + r("avg_fare_amount")
    + ", "
    + r("avg_duration_min")
    + " FROM gold",
    "top_zones_per_cluster": GB
    + "SELECT prediction, zone_rank, pickup_location_id, zone_name, borough, total_trips FROM ("
    "SELECT *, CAST(row_number() OVER (PARTITION BY prediction ORDER BY total_trips DESC, pickup_location_id) "
    "AS INTEGER) AS zone_rank FROM gold) WHERE zone_rank <= 5",
    "cluster_roles": GB.rstrip() + ",\n" + ROLES + "\n"
    "SELECT prediction, num_zones, " + r("mean_trips_per_zone") + ", " + r("mean_distance")
    + ", demand_rank, demand_tier, long_trips FROM roles",
    "cluster_peak_hours": GB.rstrip() + ",\n" + PEAK + "\n"
    "SELECT prediction, hour_of_day, trip_count, " + r("trip_share")
    + ", CAST(hour_rank AS INTEGER) AS hour_rank FROM peak WHERE hour_rank <= 3",
    "cluster_daypart_share": GB.rstrip() + ",\n" + DAYPART + "\n"
    "SELECT prediction, trips, " + ", ".join(
        r(c) for c in ["weekend_share", "morning_rush_share", "evening_rush_share", "night_share"]
    ) + " FROM dp",
    "cluster_recommendations": GB.rstrip() + ",\n" + ",\n".join([ROLES, PEAK, DAYPART, ADVICE]) + "\n"
    "SELECT roles.prediction, demand_rank, roles.demand_tier, long_trips, num_zones, advice_code, advice, "
    "peak_hour, " + r("weekend_share") + ", " + r("evening_rush_share") + " FROM roles "
    "LEFT JOIN advice ON roles.demand_tier = advice.demand_tier "
    "LEFT JOIN (SELECT prediction, min(hour_of_day) AS peak_hour FROM peak WHERE hour_rank <= 1 "
    "GROUP BY prediction) pk ON roles.prediction = pk.prediction "
    "LEFT JOIN dp ON roles.prediction = dp.prediction",
    # profiling
    "row_count": with_(RAW_B, DERIVED, SILVER)
    + "SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM silver) AS silver_rows",
    "preview": SB + f"SELECT * FROM silver ORDER BY {SILVER_COLS} LIMIT 10",
    "data_profile": _profile(),
    "distance_histogram": SB
    + "SELECT CAST(floor(trip_distance / CAST(5.0 AS DOUBLE)) * CAST(5.0 AS DOUBLE) AS DOUBLE) AS bin_start, "
    "count(*) AS trips FROM silver WHERE trip_distance IS NOT NULL AND NOT isnan(trip_distance) GROUP BY 1",
    "feature_correlation": _correlation(),
    "rank_correlation": _rank_correlation(),
    "sketched_quantiles": SB + SKETCHED_QUANTILES,
    "sketched_distinct": SB + SKETCHED_DISTINCT,
    # streaming (batch equivalent)
    "window_alerts_batch": WINDOW_ALERTS,
    "stream_demand_alerts": WINDOW_ALERTS,
    "reconciled_stream_alerts": WINDOW_ALERTS,
    "stream_alert_episodes": ALERT_EPISODES,
}


# -- clustering: vectors, and what every right labelling has in common ---------

def _features(expr: str = "{c}") -> str:
    return ", ".join(r(f"CAST({expr.format(c=c)} AS DOUBLE)", f"f_{c}") for c in FEATURES)


ZB = with_(RAW_B, DERIVED, SILVER, ZF)
_POINTS = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)
_SQUARE = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATURES)

ORACLE_SQL |= {
    "assemble_features": ZB + f"SELECT pickup_location_id, {_features()} FROM zf",
    "scaled_features": ZB
    + f"SELECT pickup_location_id, {_features('({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()')} FROM zf",
    "write_gold_vectors": GB + f"SELECT pickup_location_id, prediction, {_features()} FROM gold",
    "silhouette": GB.rstrip()
    + f""",
p AS (SELECT pickup_location_id AS id, prediction AS label, {_POINTS} FROM gold),
d AS (
  SELECT a.id, a.label, b.label AS other, sum({_SQUARE}) AS total, count(*) AS n
  FROM p a JOIN p b ON true GROUP BY a.id, a.label, b.label),
s AS (
  SELECT id, label,
         max(CASE WHEN other = label THEN n END) AS own,
         max(CASE WHEN other = label THEN total / NULLIF(n - 1, 0) END) AS inside,
         min(CASE WHEN other <> label THEN total / n END) AS outside
  FROM d GROUP BY id, label)
SELECT ROUND(avg(CASE WHEN own = 1 THEN 0 ELSE (outside - inside) / greatest(inside, outside) END), 6) AS silhouette
FROM s""",
    "kmeans_sweep": ZB
    + "SELECT k, k <= (SELECT count(*) FROM (SELECT DISTINCT "
    + ", ".join(FEATURES)
    + " FROM zf)) AS scored, true AS chosen_is_best FROM (VALUES (3), (4), (5), (6)) AS t(k)",
    "gold_kmeans": GB
    + "SELECT pickup_location_id, zone_name, borough, true AS labelled, total_trips, "
    + ", ".join(r(c) for c in FEATURES[1:])
    + " FROM gold",
    "kmeans_assign": ZB
    + "SELECT count(*) AS zones, CAST(sum(total_trips) AS BIGINT) AS trips, CAST(0 AS BIGINT) AS violations FROM zf",
    "kmeans_cluster_summary": ZB
    + "SELECT CAST(count(*) AS BIGINT) AS num_zones, CAST(sum(total_trips) AS BIGINT) AS total_trips, "
    + r("avg(avg_trip_distance)", "avg_distance")
    + " FROM zf",
    "schema_profile": """
SELECT column_name AS "column", CAST(ordinal_position - 1 AS INTEGER) AS position,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS data_type,
       true AS nullable
FROM information_schema.columns WHERE table_name = 'lineitem'""",
    "distribution_summary": SB
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({q} AS DOUBLE) AS quantile, quantile_disc({c}, {q}) AS value FROM silver"
        for c in ("trip_distance", "fare_amount", "avg_speed_mph")
        for q in (0.25, 0.5, 0.75, 0.9)
    ),
}
