"""Demand aggregates: boundary frames, ordering, invariants."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from zonepulse.operators import demand
from zonepulse.plans import inputs

SILVER_SCHEMA = (
    "trip_distance double, pickup_location_id bigint, dropoff_location_id bigint, year int, month int, "
    "day int, day_of_week int, hour_of_day int, trip_duration_min double, avg_speed_mph double, "
    "fare_amount double, tip_amount double, total_amount double"
)


def silver_row(zone=1, hour=12, dow=0, day=1, year=2024, month=1):
    return (3.0, zone, 2, year, month, day, dow, hour, 10.0, 18.0, 9.0, 1.0, 11.0)


def test_rush_hour_is_inclusive(spark):
    df = spark.createDataFrame([silver_row(hour=h) for h in (15, 16, 19, 20)], SILVER_SCHEMA)
    hours = sorted(r[0] for r in demand.rush_hour_trips(df).select("hour_of_day").collect())
    assert hours == [16, 19]


def test_weekday_names_unmapped_and_null_sort_first(spark):
    rows = [silver_row(dow=d) for d in range(7)] + [silver_row(dow=7), silver_row(dow=None)]
    df = spark.createDataFrame(rows, SILVER_SCHEMA)
    out = demand.dow_demand_named(df).collect()
    names = [r["day_name"] for r in out]
    assert names == [None, "Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert out[0]["trip_count"] == 2  # weekday 7 and NULL both map to NULL


def test_top_zones_ties_broken_by_lowest_id(spark):
    rows = [silver_row(zone=z) for z in range(100, 125)]  # 25 zones, one trip each
    df = spark.createDataFrame(rows, SILVER_SCHEMA)
    top = demand.top_pickup_zones(df, 20).collect()
    assert [r["pickup_location_id"] for r in top] == list(range(100, 120))


def test_top_zones_plan_is_a_top_k(spark):
    from conftest import plan_text

    plan = plan_text(demand.top_pickup_zones(inputs.silver_trips(spark, SF_SMALL), 20))
    assert "TakeOrderedAndProject" in plan


def test_hourly_average_counts_only_days_with_trips(spark):
    # hour 8 on day 1 (3 trips) only; hour 9 on days 1, 2, 3 (1, 2, 3 trips)
    rows = [silver_row(hour=8, day=1)] * 3
    rows += [silver_row(hour=9, day=d) for d in (1, 2, 2, 3, 3, 3)]
    df = spark.createDataFrame(rows, SILVER_SCHEMA)
    got = {r["hour_of_day"]: r["avg_trips_per_hour"] for r in demand.hourly_avg_demand(df).collect()}
    assert got == {8: 3.0, 9: 2.0}


def test_sums_agree_with_silver_rows(spark):
    silver = inputs.silver_trips(spark, SF_SMALL)
    n = silver.count()
    for frame in (
        demand.hourly_demand(silver),
        demand.dow_demand(silver),
        demand.hour_dow_heatmap(silver),
        demand.hourly_zone_demand(silver),
        demand.monthly_demand(silver),
        demand.hourly_per_day(silver),
    ):
        assert frame.agg(F.sum("trip_count")).first()[0] == n


def test_grouping_sets_equal_separate_aggregates(spark):
    silver = inputs.silver_trips(spark, SF_SMALL)
    t = demand.temporal_demand(silver)
    hourly = {(r[0], r[1]) for r in t.filter("grain = 'hour'").select("hour_of_day", "trip_count").collect()}
    assert hourly == {(r[0], r[1]) for r in demand.hourly_demand(silver).collect()}
    dow = {(r[0], r[1]) for r in t.filter("grain = 'dow'").select("day_of_week", "trip_count").collect()}
    assert dow == {(r[0], r[1]) for r in demand.dow_demand(silver).collect()}
    cells = {tuple(r) for r in t.filter("grain = 'dow_hour'").select("day_of_week", "hour_of_day", "trip_count").collect()}
    assert cells == {tuple(r) for r in demand.hour_dow_heatmap(silver).collect()}


def test_sorted_outputs(spark):
    silver = inputs.silver_trips(spark, SF_SMALL)
    hours = [r[0] for r in demand.hourly_demand(silver).collect()]
    assert hours == sorted(hours) and len(hours) == 24
    days = [r[0] for r in demand.dow_demand(silver).collect()]
    assert days == list(range(7))
    counts = [r["trip_count"] for r in demand.rush_hour_hotspots(silver).collect()]
    assert counts == sorted(counts, reverse=True)
