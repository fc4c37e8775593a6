"""Row order of the ordered outputs (the SQL oracle comparison ignores
order, so it is checked here)."""

import pytest

from conftest import SF_MID
from zonepulse.operators import demand, insights, profile, zones
from zonepulse.plans import inputs


@pytest.fixture(scope="module")
def layers(spark):
    return inputs.silver_trips(spark, SF_MID), inputs.demand_band_gold(spark, SF_MID), inputs.zones(spark, SF_MID)


def keys(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def desc_then_asc(rows):
    """rows of (count, tiebreak...) sorted by count desc, then tiebreak asc"""
    return rows == sorted(rows, key=lambda t: (-t[0],) + t[1:])


def test_descending_reports_with_tie_breaks(layers):
    silver, gold, zone_dim = layers
    assert desc_then_asc(keys(demand.top_pickup_zones(silver, None), "trip_count", "pickup_location_id"))
    assert desc_then_asc(keys(zones.top_zones_named(silver, zone_dim, 20), "trip_count", "pickup_location_id"))
    assert desc_then_asc(keys(insights.hotspots(gold, 0), "total_trips", "pickup_location_id"))
    assert desc_then_asc(keys(insights.demand_alerts(silver), "trip_count", "pickup_location_id", "hour_of_day"))
    assert desc_then_asc(keys(insights.recommendations(gold), "total_trips", "zone_name", "prediction"))


def test_ascending_and_custom_orders(layers):
    silver, gold, _ = layers
    for df, cols in [
        (demand.hourly_demand(silver), ("hour_of_day",)),
        (demand.dow_demand(silver), ("day_of_week",)),
        (demand.hourly_avg_demand(silver), ("hour_of_day",)),
        (demand.monthly_demand(silver), ("year", "month")),
        (insights.cluster_summary(gold), ("prediction",)),
        (insights.cluster_hourly_demand(silver, gold), ("hour_of_day",)),
    ]:
        rows = keys(df, *cols)
        assert rows == sorted(rows), cols
    names = [r[0] for r in keys(demand.dow_demand_named(silver), "day_name")]
    assert names == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    by_cluster = keys(insights.zones_by_cluster(gold), "prediction", "total_trips")
    assert by_cluster == sorted(by_cluster, key=lambda t: (t[0], -t[1]))


def test_profile_counts_nulls_and_nans(spark):
    df = spark.createDataFrame(
        [(1.0, 1), (None, 2), (float("nan"), None), (4.0, 4)], "x double, n bigint"
    )
    prof = {r["column"]: r for r in profile.data_profile(df).collect()}
    assert (prof["x"]["rows"], prof["x"]["nulls"], prof["x"]["nans"]) == (4, 1, 1)
    assert (prof["n"]["nulls"], prof["n"]["nans"], prof["n"]["min"], prof["n"]["max"]) == (1, 0, 1.0, 4.0)
    assert prof["n"]["data_type"] == "bigint"
