"""Zone dimension, joins, thresholds and cluster insights; custom pieces
(skew-safe ``lead``, salted join, quantiles) against brute force."""

import math

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from zonepulse.functions.quantiles import threshold_frame
from zonepulse.operators import insights, zones
from zonepulse.plans import inputs
from zonepulse.plans.joins import broadcast_ok, dimension_join, measured_size, salted_keys
from zonepulse.sources.adapters import next_event_time, unique_zones
from zonepulse.sources.tables import read_table


def test_duplicate_zone_ids_do_not_fan_out(spark):
    dim = spark.createDataFrame(
        [(1, "B", "x"), (1, "A", "y"), (2, "C", "z")], "zone_id bigint, zone_name string, borough string"
    )
    uniq = unique_zones(dim)
    assert uniq.count() == 2
    assert uniq.filter("zone_id = 1").first()["zone_name"] == "A"
    facts = spark.createDataFrame([(1, 5), (3, 7)], "pickup_location_id bigint, total_trips bigint")
    named = zones.attach_zone_names(facts, uniq).orderBy("pickup_location_id").collect()
    assert len(named) == 2
    assert named[1]["zone_name"] is None  # zone 3 has no dimension row: kept, NULL name


def brute_percentile_disc(values, q):
    values = sorted(values)
    if not values:
        return None
    idx = max(0, math.ceil(q * len(values)) - 1)
    return values[idx]


@pytest.mark.parametrize("n", [0, 1, 4, 10, 20])
@pytest.mark.parametrize("q", [0.25, 0.5, 0.75, 0.9])
def test_percentile_disc_is_an_element(spark, n, q):
    values = [(i * 7) % 13 for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    got = threshold_frame(df, "x", q).first()[0]
    assert got == brute_percentile_disc(values, q)


def test_hotspot_threshold_is_inclusive(spark):
    gold = inputs.demand_band_gold(spark, SF_MID)
    thr = insights.trips_threshold(gold).first()[0]
    hot = insights.hotspots(gold, cluster=0).collect()
    assert all(r["total_trips"] >= thr and r["prediction"] == 0 for r in hot)
    expected = gold.filter((F.col("prediction") == 0) & (F.col("total_trips") >= thr)).count()
    assert len(hot) == expected
    assert thr == 543  # recorded exact p75 for this fixture


def test_alert_threshold_and_ties(spark):
    silver = inputs.silver_trips(spark, SF_MID)
    assert insights.demand_threshold(silver).first()[0] == 28
    assert insights.demand_alerts(silver).count() == 284


def test_cluster_totals_add_up(spark):
    silver = inputs.silver_trips(spark, SF_MID)
    gold = inputs.demand_band_gold(spark, SF_MID)
    total = insights.cluster_summary(gold).agg(F.sum("total_trips_cluster")).first()[0]
    assert total == silver.count()
    by_hour = insights.cluster_hourly_demand(silver, gold, cluster=0).agg(F.sum("trip_count")).first()[0]
    in_cluster = insights.trips_with_cluster(silver, gold).filter("prediction = 0").count()
    assert by_hour == in_cluster


def test_top_zones_per_cluster_matches_pandas(spark):
    gold = inputs.demand_band_gold(spark, SF_MID)
    got = {(r["prediction"], r["zone_rank"], r["pickup_location_id"]) for r in insights.top_zones_per_cluster(gold, 3).collect()}
    pdf = gold.select("prediction", "pickup_location_id", "total_trips").toPandas()
    pdf = pdf.sort_values(["prediction", "total_trips", "pickup_location_id"], ascending=[True, False, True])
    pdf["rank"] = pdf.groupby("prediction").cumcount() + 1
    want = {(int(a), int(b), int(c)) for a, b, c in pdf[pdf["rank"] <= 3][["prediction", "rank", "pickup_location_id"]].values}
    assert got == want


def test_cluster_roles_rank_every_cluster(spark):
    gold = inputs.demand_band_gold(spark, SF_MID)
    roles = insights.cluster_roles(gold).orderBy("demand_rank").collect()
    means = [r["mean_trips_per_zone"] for r in roles]
    assert means == sorted(means, reverse=True)
    assert {r["demand_tier"] for r in roles} <= {"high_demand", "moderate_demand", "baseline"}
    recs = insights.cluster_recommendations(inputs.silver_trips(spark, SF_MID), gold).collect()
    assert len(recs) == len(roles) and all(r["advice_code"] for r in recs)


def test_skew_safe_lead_equals_plain_window(spark):
    events = read_table(spark, SF_MID, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = events.select("event_id", F.lead("ts").over(w).alias("expected"))
    for parts in (1, 3, 16, 64):
        ours = next_event_time(events, partitions=parts).select("event_id", "next_ts")
        diff = ours.join(plain, "event_id").filter(~F.col("next_ts").eqNullSafe(F.col("expected")))
        assert diff.count() == 0, parts
        assert ours.count() == events.count()


def test_salted_join_equals_broadcast_join(spark):
    # one zone holds most trips: force the shuffle path and salt it
    facts = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 != 0, F.lit(7)).otherwise(F.col("id") % 50).alias("pickup_location_id"),
        F.col("id").alias("trip_id"),
    )
    dim = spark.range(0, 40).select(F.col("id").alias("zone_id"), (F.col("id") * 10).alias("label"))
    assert {r[0]: r[1] for r in salted_keys(facts, "pickup_location_id", 500).collect()} == {7: 7}
    salted = dimension_join(facts, dim, "pickup_location_id", "zone_id", "left", max_rows=0, rows_per_salt=500)
    broadcast = dimension_join(facts, dim, "pickup_location_id", "zone_id", "left")
    a = sorted(tuple(r) for r in salted.select("trip_id", "pickup_location_id", "label").collect())
    b = sorted(tuple(r) for r in broadcast.select("trip_id", "pickup_location_id", "label").collect())
    assert a == b and len(a) == 5000


def test_top_zones_named_keeps_unmatched(spark):
    named = zones.top_zones_named(inputs.silver_trips(spark, SF_SMALL, "events"), inputs.zones(spark, SF_SMALL), None)
    rows = named.collect()
    assert sum(r["trip_count"] for r in rows) == inputs.silver_trips(spark, SF_SMALL, "events").count()
    assert any(r["zone_name"] is None for r in rows)  # fixture A has zones beyond the suppliers
    counts = [r["trip_count"] for r in rows]
    assert counts == sorted(counts, reverse=True)


def test_profile_and_distribution(spark):
    from zonepulse.operators import profile

    silver = inputs.silver_trips(spark, SF_SMALL)
    prof = {r["column"]: r for r in profile.data_profile(silver).collect()}
    pdf = silver.toPandas()
    assert prof["trip_distance"]["rows"] == len(pdf)
    assert prof["trip_distance"]["max"] == pdf["trip_distance"].max()
    assert abs(prof["fare_amount"]["mean"] - pdf["fare_amount"].mean()) < 1e-9
    hist = profile.histogram(silver, "trip_distance", 5.0).collect()
    assert sum(r["trips"] for r in hist) == len(pdf)
    corr = profile.feature_correlation(silver, ["trip_distance", "fare_amount"]).first()["corr"]
    assert abs(corr - pd.Series(pdf["trip_distance"]).corr(pdf["fare_amount"])) < 1e-9


def test_distribution_summary_is_exact(spark):
    from zonepulse.operators import profile

    silver = inputs.silver_trips(spark, SF_MID)
    columns = ["fare_amount", "trip_distance", "hour_of_day"]
    pdf = silver.select(*columns).toPandas()
    for bound, bins in ((65_536, 4096), (3, 4)):  # at once, and in many rounds
        got = profile.distribution_summary(silver, columns, (0.0, 0.25, 0.5, 0.9, 1.0), bound, bins).collect()
        assert len(got) == 15
        for r in got:
            assert r["value"] == brute_percentile_disc(sorted(pdf[r["column"]].tolist()), r["quantile"])
    rows = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (3.0, None)], "a double, b double")
    got = {(r["column"], r["quantile"]): r["value"] for r in profile.distribution_summary(rows, ["a", "b"], (0.3, 0.5)).collect()}
    assert got == {("a", 0.3): 1.0, ("a", 0.5): 3.0, ("b", 0.3): None, ("b", 0.5): None}


def test_summary_keeps_types_and_extreme_values(spark):
    from decimal import Decimal

    from zonepulse.operators import profile

    big = 2**53 + 1
    rows = spark.createDataFrame([(big + i, Decimal(i) / 100) for i in range(-40, 41)], "a bigint, d decimal(20,2)")
    whole = profile.distribution_summary(rows, ["a"], (0.5, 1.0), values_per_task=5, bins=2).collect()
    assert {r["quantile"]: r["value"] for r in whole} == {0.5: big, 1.0: big + 40}
    exact = profile.distribution_summary(rows, ["d", "a"], (0.5,), values_per_task=5, bins=2)
    assert dict(exact.dtypes)["value"].startswith("decimal")
    assert {r["column"]: r["value"] for r in exact.collect()} == {"a": big, "d": 0}
    odd = [float("-inf")] * 3 + [-1.7e308, -1e-320, 0.0, 5e-324, 1.0, 1.0000000000000002, 1.7e308] + [float("inf")] * 2 + [float("nan")] * 2
    frame = spark.createDataFrame([(x,) for x in odd], "x double")
    for bound in (1, 3, 100):
        got = profile.distribution_summary(frame, ["x"], [k / 14 for k in range(1, 15)], values_per_task=bound, bins=3).orderBy("quantile")
        assert [str(r["value"]) for r in got.collect()] == [str(x) for x in odd]


def test_summary_sorts_no_more_than_its_bound(spark, monkeypatch):
    """Every round's ranges, and the values the last step sorts."""
    from zonepulse.operators import profile

    seen = []
    narrowed = profile._narrowed
    monkeypatch.setattr(profile, "_narrowed", lambda *a: seen.append(narrowed(*a)) or seen[-1])
    rows = spark.range(50_000).selectExpr("id * id * 0.5 AS x")
    got = profile.distribution_summary(rows, ["x"], (0.25, 0.9), values_per_task=500, bins=16).collect()
    assert {r["quantile"]: r["value"] for r in got} == {0.25: 12_499**2 * 0.5, 0.9: 44_999**2 * 0.5}
    assert 2 <= len(seen) <= 6 and max(r["distinct"] for r in seen[-1].collect()) <= 500


def test_named_zone_rows_win_over_nulls(spark):
    rows = [(1, None, None), (1, "A", "X"), (2, None, "Y"), (2, None, None), (3, "B", None), (3, "B", "Z"), (4, None, None)]
    got = unique_zones(spark.createDataFrame(rows, "zone_id bigint, zone_name string, borough string")).collect()
    assert {tuple(r) for r in got} == {(1, "A", "X"), (2, None, "Y"), (3, "B", "Z"), (4, None, None)}


def test_cells_give_what_the_trips_give(spark):
    from zonepulse.operators import demand
    from zonepulse.operators.zones import demand_cells, zone_features

    silver = inputs.silver_trips(spark, SF_SMALL)
    cells = demand_cells(silver)
    gold = inputs.demand_band_gold(spark, SF_SMALL)
    exact = [
        demand.hourly_demand, demand.dow_demand_named, demand.heatmap_named, demand.temporal_demand, demand.top_pickup_zones,
        demand.rush_hour_hotspots, demand.hourly_zone_demand, insights.demand_alerts, lambda x: insights.cluster_hourly_demand(x, gold),
    ]
    for f in exact:
        assert sorted(map(str, f(cells).collect())) == sorted(map(str, f(silver).collect()))
    a, b = ({r[0]: r for r in zone_features(x).collect()} for x in (cells, silver))
    assert a.keys() == b.keys()
    assert all(abs(x - y) < 1e-9 for z in a for x, y in zip(a[z], b[z]))


def test_skew_safe_lead_with_a_hot_user(spark):
    import datetime as dt

    # user 1 holds most events (pairs share a timestamp, ordered by event
    # id); users 2 and 3 are sparse. The hot user spans many partitions.
    base = dt.datetime(2024, 3, 1)
    rows = []
    for i in range(3000):
        rows.append((i, base + dt.timedelta(minutes=7 * (i // 2)), 1))
    rows += [(10_000 + i, base + dt.timedelta(hours=13 * i), 2 + i % 2) for i in range(40)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = events.select("event_id", F.lead("ts").over(w).alias("expected"))
    ours = next_event_time(events, partitions=16).select("event_id", "next_ts")
    joined = ours.join(plain, "event_id")
    assert joined.count() == len(rows)
    assert joined.filter(~F.col("next_ts").eqNullSafe(F.col("expected"))).count() == 0


def test_event_trips_do_not_depend_on_exchange_reuse(spark):
    """Every step must see the same range partition ids even when Spark
    does not reuse the range exchange (it samples bounds per exchange)."""
    from zonepulse.sources.adapters import trips_from_events

    events = read_table(spark, SF_MID, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    secs = lambda c: F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c) / 1e6)
    expected = events.select(
        F.col("event_id").alias("trip_id"), (secs(F.lead("ts").over(w)) - secs(F.col("ts"))).alias("want")
    )
    previous = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = trips_from_events(events, partitions=16).select("trip_id", "trip_duration", "fare_amount")
        diff = got.join(expected, "trip_id").filter(~F.col("trip_duration").eqNullSafe(F.col("want")))
        assert diff.count() == 0
        assert got.count() == events.count()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", previous)


def _largest_share(df):
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    return max(sizes) / sum(sizes)


def test_null_keys_and_keys_below_one_percent_are_spread(spark):
    """Half the facts have no key; the rest is 112 keys of many rows each."""
    facts = spark.range(0, 40_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 113).cast("bigint").alias("k"), F.col("id")
    )
    facts = facts.withColumn("tags", F.create_map(F.lit("a"), F.col("id")))  # maps cannot be hashed
    dim = spark.range(0, 200).select(F.col("id").alias("zone_id"), (F.col("id") * 10).alias("label"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert salted_keys(facts, "k", 50).count() == 113
        joined = dimension_join(facts, dim, "k", "zone_id", "left", max_rows=0, rows_per_salt=50)
        assert _largest_share(joined) < 0.35  # four partitions
        assert joined.where("k IS NULL AND label IS NULL").count() == 20_000
        assert joined.where("label = k * 10").count() == 20_000
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_wide_dimensions_are_measured_not_guessed(spark):
    wide = spark.range(0, 1_000).select(F.col("id").alias("zone_id"), F.repeat(F.lit("x"), 300_000).alias("name"))
    rows, size = measured_size(wide)
    assert rows == 1_000 and size > 300_000_000 and not broadcast_ok(wide)
    assert measured_size(wide.select("zone_id", F.array("name").alias("names"))) is None
    assert broadcast_ok(wide.select("zone_id"))
    assert measured_size(wide.limit(0)) == (0, 0)
