"""Query registry: one entry per operator of the inventory.

Each query takes ``(spark, sf_dir)``, reads the shipped tables and returns a
DataFrame. Double columns are rounded to ``DIGITS`` decimals at this outer
layer only (the operators keep full precision) so that results can be
compared with an independent SQL engine whose summation order differs.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.operators import clean, cluster, demand, insights, profile, ranks, zones
from zonepulse.operators.cluster import cluster_zones, sweep_frame
from zonepulse.plans import buckets, inputs, refresh, sketches
from zonepulse.plans.medallion import write_silver
from zonepulse.session import scratch_dir
from zonepulse.sources.sinks import bronze_clone, write_and_check
from zonepulse.sources.tables import read_table, table_location
from zonepulse.streaming import alerts as stream_alerts
from zonepulse.streaming import late

DIGITS = 6
Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame, digits: int = DIGITS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round double columns except ``keep`` (keeps names and order).

    Aggregated doubles differ in the last bits between engines (summation
    order); per-row doubles are bit-identical and are kept exact, which
    also avoids round-half ties on short decimals.
    """
    cols = [
        F.round(F.col(n), digits).alias(n) if t in ("double", "float") and n not in keep else F.col(n)
        for n, t in df.dtypes
    ]
    return df.select(*cols)


def _q(fn: Callable[..., DataFrame], keep: tuple[str, ...] | bool = ()) -> Query:
    """Wrap a query; ``keep=True`` leaves every column exact."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        if keep is True:
            return df
        return comparable(df, keep=tuple(keep or ()))

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _silver(spark, sf, fixture="lineitem"):
    return inputs.silver_trips(spark, sf, fixture)


def _raw(spark, sf, fixture="lineitem"):
    return inputs.raw_trips(spark, sf, fixture)


def _gold(spark, sf, fixture="lineitem"):
    return inputs.demand_band_gold(spark, sf, fixture)


# -- sources / sinks ---------------------------------------------------------

def q_scan_raw(spark, sf):
    """Canonical raw trips (fixture B)."""
    return _raw(spark, sf)


def q_scan_zones(spark, sf):
    """The zone dimension (unique zone_id)."""
    return inputs.zones(spark, sf)


def q_write_silver(spark, sf):
    """K2 + K8: write silver to a fresh folder under the checkpoint folder,
    verify, and return the re-scanned table."""
    target = os.path.join(scratch_dir(spark, "silver"), "silver_trips")
    return write_silver(_silver(spark, sf), target)


def q_bronze_clone(spark, sf):
    """K1: copy the raw ``lineitem`` table unchanged and read it back."""
    target = os.path.join(scratch_dir(spark, "bronze"), "lineitem")
    return bronze_clone(spark, table_location(sf, "lineitem"), target)


def _write_read(spark, df, name):
    target = os.path.join(scratch_dir(spark, name), name)
    return write_and_check(spark, df, target)


def q_write_hourly_demand(spark, sf):
    """K3: hourly demand, written and read back."""
    return _write_read(spark, demand.hourly_demand(_silver(spark, sf)), "hourly_demand")


def q_write_dow_demand(spark, sf):
    """K4: weekday demand, written and read back."""
    return _write_read(spark, demand.dow_demand(_silver(spark, sf)), "dow_demand")


def q_write_gold(spark, sf):
    """K6: named gold zones (demand-band clusters), written and read back."""
    return _write_read(spark, _gold(spark, sf), "gold")


def q_write_recommendations(spark, sf):
    """K7: the recommendation table, written and read back."""
    return _write_read(spark, insights.recommendations(_gold(spark, sf)), "recommendations")


def _delivered_late(spark, sf):
    """A store of all trips that was first built with the last month missing
    and the middle one with wrong fares, then refreshed by those two months."""
    raw = _raw(spark, sf)
    months = raw.agg(F.max(F.struct("year", "month")).alias("m"), F.min(F.struct("year", "month")).alias("f")).first()
    middle = ((months["f"][0] * 12 + months["f"][1] - 1) + (months["m"][0] * 12 + months["m"][1] - 1)) // 2
    number = F.col("year") * 12 + F.col("month") - 1
    last = number == months["m"][0] * 12 + months["m"][1] - 1
    wrong = F.when(number == middle, F.col("fare_amount") + 100).otherwise(F.col("fare_amount"))
    store = scratch_dir(spark, "day-cells")
    refresh.refresh(raw.where(~last).withColumn("fare_amount", wrong), store, refresh.MONTH)
    return refresh.refresh(raw.where(last | (number == middle)), store, refresh.MONTH)


def q_refreshed_zone_features(spark, sf):
    """K2-K6: zone features from cells of which two months were refreshed."""
    return zones.zone_features(refresh.merged_cells(_delivered_late(spark, sf)))


def q_refreshed_heatmap(spark, sf):
    """K3/K4: weekday and hour demand from cells refreshed by month."""
    return demand.hour_dow_heatmap(refresh.merged_cells(_delivered_late(spark, sf)))


# -- cleaning ----------------------------------------------------------------

def q_clean_trips(spark, sf):
    """silver trips, fixture B."""
    return _silver(spark, sf)


def q_clean_trips_events(spark, sf):
    """silver trips, fixture A (durations from the next event)."""
    return _silver(spark, sf, "events")


def q_cleaning_funnel(spark, sf):
    """I4: cleaning funnel, fixture B."""
    return clean.cleaning_funnel(_raw(spark, sf))


def q_cleaning_funnel_events(spark, sf):
    """I4: cleaning funnel, fixture A."""
    return clean.cleaning_funnel(_raw(spark, sf, "events"))


def q_filter_distance(spark, sf):
    """F1 alone (fixture A, where it removes rows)."""
    return clean.filter_distance(_raw(spark, sf, "events"))


def q_filter_duration(spark, sf):
    """F2 alone (fixture A)."""
    return clean.filter_duration(_raw(spark, sf, "events"))


def q_filter_total_amount(spark, sf):
    """F3 alone (fixture A)."""
    return clean.filter_total_amount(_raw(spark, sf, "events"))


def q_filter_locations(spark, sf):
    """F4 alone (fixture A: zone 0 exists)."""
    return clean.filter_locations(_raw(spark, sf, "events"))


def q_derive_features(spark, sf):
    """P1-P4 after F1-F4: durations and speed before the speed filters."""
    raw = _raw(spark, sf)
    return (
        raw.transform(clean.filter_distance)
        .transform(clean.filter_duration)
        .transform(clean.filter_total_amount)
        .transform(clean.filter_locations)
        .transform(clean.derive_durations)
        .transform(clean.derive_speed)
    )


def q_filter_speed(spark, sf):
    """F5 + F6 after the derivations (fixture A)."""
    raw = _raw(spark, sf, "events")
    return (
        raw.transform(clean.derive_durations)
        .transform(clean.derive_speed)
        .transform(clean.drop_missing_speed)
        .transform(clean.filter_speed)
    )


def q_speed_sanity(spark, sf):
    """The 10 fastest silver trips."""
    return clean.speed_sanity(_silver(spark, sf))


# -- demand --------------------------------------------------------------------

def _on_silver(op, fixture="lineitem"):
    def run(spark, sf):
        return op(_silver(spark, sf, fixture))

    run.__doc__ = op.__doc__
    run.__name__ = op.__name__
    return run


def q_rush_hour_trips(spark, sf):
    """rush-hour trips (silver rows, hours 16-19)."""
    return demand.rush_hour_trips(_silver(spark, sf))


def q_top_zones_all(spark, sf):
    """G4 with no cut: every zone by trips."""
    return demand.top_pickup_zones(_silver(spark, sf), None)


# -- zones ---------------------------------------------------------------------

def q_zone_count(spark, sf):
    """G7."""
    return zones.zone_count(zones.zone_features(_silver(spark, sf)))


def q_zone_names(spark, sf):
    """Zone features LEFT JOIN zone names (fixture A: unmatched zones)."""
    feats = zones.zone_features(_silver(spark, sf, "events"))
    return zones.attach_zone_names(feats, inputs.zones(spark, sf))


def q_top_zones_named(spark, sf):
    """Top-20 zones with names."""
    return zones.top_zones_named(_silver(spark, sf), inputs.zone_rows(spark, sf), 20)


def q_top_zones_named_all(spark, sf):
    """All zones with names, busiest first."""
    return zones.top_zones_named(_silver(spark, sf), inputs.zone_rows(spark, sf), None)


def q_top_zones_named_events(spark, sf):
    """J3 on fixture A (ties at the cut, unmatched names)."""
    return zones.top_zones_named(_silver(spark, sf, "events"), inputs.zone_rows(spark, sf), 20)


# -- cluster insights on the demand-band gold (SQL-checkable) -------------------

def _on_gold(op, **kw):
    def run(spark, sf):
        return op(_gold(spark, sf), **kw)

    run.__doc__ = op.__doc__
    run.__name__ = op.__name__
    return run


def q_trips_with_cluster_bucketed(silver, gold):
    """J2 of a layer that was written once, bucketed by zone, and read for the
    join without an exchange; zones beyond 1/16 of the trips are split."""
    rows_per_part = max(1, silver.count() // 16)
    key = "pickup_location_id"
    layer, dim = buckets.scratch_tables(
        silver, key, insights.cluster_keys(gold), key, buckets=16, rows_per_part=rows_per_part
    )
    return buckets.bucketed_join(layer, dim, key)


def _on_silver_gold(op, **kw):
    def run(spark, sf):
        return op(_silver(spark, sf), _gold(spark, sf), **kw)

    run.__doc__ = op.__doc__
    run.__name__ = op.__name__
    return run


def q_gold_demand_bands(spark, sf):
    """Gold rows (clusters = demand bands)."""
    return _gold(spark, sf)


def q_demand_alerts_events(spark, sf):
    """T4 on fixture A (many ties at the threshold)."""
    return insights.demand_alerts(_silver(spark, sf, "events"))


def q_cluster_keys(spark, sf):
    """(zone, cluster) pairs."""
    return insights.cluster_keys(_gold(spark, sf))


# -- clustering -----------------------------------------------------------------
# K-Means labels differ between engines, so these queries return what any
# right labelling has in common; tests/test_cluster.py checks the labels.

def _kmeans(spark, sf):
    return cluster_zones(zones.zone_features(_silver(spark, sf)), keep_features=True)


def _vector_columns(df):
    """One double column per feature out of the vector column."""
    values = vector_to_array("features")
    return [values[i].alias(f"f_{name}") for i, name in enumerate(zones.FEATURE_COLUMNS)]


def q_assemble_features(spark, sf):
    """M1: the feature vector of every zone, read back from the vector."""
    vectors = cluster.assemble_features(zones.zone_features(_silver(spark, sf)))
    return vectors.select("pickup_location_id", *_vector_columns(vectors))


def q_scaled_features(spark, sf):
    """The standardised feature vector of every zone."""
    vectors = cluster.assemble_features(zones.zone_features(_silver(spark, sf)), scale=True)
    return vectors.select("pickup_location_id", *_vector_columns(vectors))


def q_write_gold_vectors(spark, sf):
    """K5: zones with feature vector and cluster (demand bands), written and
    read back."""
    vectors = cluster.assemble_features(_gold(spark, sf)).select("pickup_location_id", "features", "prediction")
    stored = _write_read(spark, vectors, "gold_vectors")
    return stored.select("pickup_location_id", "prediction", *_vector_columns(stored))


def q_silhouette(spark, sf):
    """M4: mean silhouette (squared Euclidean) of the demand-band clusters."""
    vectors = cluster.assemble_features(_gold(spark, sf))
    score = cluster.silhouette(vectors.select("features", F.col("prediction").cast("double").alias("prediction")))
    return spark.range(1).select(F.lit(score).cast("double").alias("silhouette"))


def q_kmeans_sweep(spark, sf):
    """M5/M6: every K of the sweep, whether it could be scored (it can when
    there are that many distinct points), and whether the chosen K scores
    highest."""
    _, sweep = _kmeans(spark, sf)
    rows = sweep_frame(spark, sweep)
    best = rows.agg(F.max("silhouette").alias("s")).scalar()
    top = rows.where("chosen").agg(F.max("silhouette").alias("s")).scalar()
    return rows.select(
        "k", F.coalesce(F.col("silhouette").between(-1, 1), F.lit(False)).alias("scored"), (top == best).alias("chosen_is_best")
    )


def q_gold_kmeans(spark, sf):
    """M1-M7 + J1 + P6: K-Means gold; ``labelled`` in place of the label."""
    clustered, _ = _kmeans(spark, sf)
    gold = inputs.gold_from_predictions(clustered, inputs.zones(spark, sf))
    return gold.withColumn("labelled", F.col("prediction").isNotNull()).drop("prediction")


def q_kmeans_assign(spark, sf):
    """M2/M3/M7: zones and trips that got a label, and zones whose label is
    not that of a nearest centre."""
    clustered, sweep = cluster_zones(zones.zone_features(_silver(spark, sf)), canonical_labels=False, keep_features=True)
    if sweep.best_model is None:
        far = F.lit(False)
    else:
        centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in sweep.best_model.clusterCenters()])
        squares = F.transform(
            centres,
            lambda c: F.aggregate(F.zip_with(c, vector_to_array("features"), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x),
        )
        least = F.array_min(squares)
        far = F.element_at(squares, F.col("prediction") + 1) > least + F.greatest(F.lit(1.0), least) * 1e-9
    labelled = F.col("prediction").isNotNull()
    return clustered.agg(
        F.count_if(labelled).alias("zones"),
        F.sum(F.when(labelled, F.col("total_trips"))).alias("trips"),
        F.count_if(labelled & far).alias("violations"),
    )


def q_kmeans_cluster_summary(spark, sf):
    """G8 on the K-Means gold, summed over the clusters: zones and trips, and
    the mean of zone mean distances weighted back by zones."""
    clustered, _ = _kmeans(spark, sf)
    per = insights.cluster_summary(inputs.gold_from_predictions(clustered, inputs.zones(spark, sf)))
    return per.agg(
        F.sum("num_zones").alias("num_zones"),
        F.sum("total_trips_cluster").alias("total_trips"),
        (F.sum(F.col("avg_distance") * F.col("num_zones")) / F.sum("num_zones")).alias("avg_distance"),
    )


# -- profiling -----------------------------------------------------------------

def q_row_count(spark, sf):
    """Raw and silver row counts."""
    raw = profile.row_count(_raw(spark, sf), "raw_rows")
    silver = profile.row_count(_silver(spark, sf), "silver_rows")
    return raw.select("raw_rows", silver.select("silver_rows").scalar().alias("silver_rows"))


def q_preview(spark, sf):
    """First 10 silver rows by a full key."""
    return profile.preview(_silver(spark, sf), 10)


def q_data_profile(spark, sf):
    """R2: one-pass profile of the raw trips."""
    return profile.data_profile(_raw(spark, sf))


def q_schema_profile(spark, sf):
    """Schema of the raw table."""
    return profile.schema_profile(spark, read_table(spark, sf, "lineitem"))


def q_distribution_summary(spark, sf):
    """Exact discrete quantiles of distance, fare and speed."""
    return profile.distribution_summary(_silver(spark, sf), ["trip_distance", "fare_amount", "avg_speed_mph"])


def q_distance_histogram(spark, sf):
    """Distance histogram, 5-mile bins."""
    return profile.histogram(_silver(spark, sf), "trip_distance", 5.0)


def q_feature_correlation(spark, sf):
    """Correlations between the zone features."""
    return profile.feature_correlation(zones.zone_features(_silver(spark, sf)), zones.FEATURE_COLUMNS)


#: Trip measures whose relations are reported.
RANKED = ("trip_distance", "trip_duration_min", "fare_amount", "tip_amount", "avg_speed_mph")


def q_rank_correlation(spark, sf):
    """Spearman correlation of the trip measures over all trips."""
    return ranks.rank_correlation(_silver(spark, sf), RANKED)


def _sketched(spark, sf):
    """Monthly sketches, delivered in two parts."""
    raw = inputs.raw_trips(spark, sf)
    store = f"{scratch_dir(spark, 'sketches')}/store"
    odd = F.col("year") % 2 == 1
    sketches.refresh_sketches(raw.where(~odd | odd.isNull()), store, refresh.MONTH)
    return sketches.refresh_sketches(raw.where(odd), store, refresh.MONTH)


def q_sketched_quantiles(spark, sf):
    """Quantiles from merged monthly KLL sketches, with their rank error
    measured against all trips."""
    return sketches.measured_quantiles(
        _sketched(spark, sf), _silver(spark, sf), sketches.MEASURES, (0.5, 0.75, 0.9), sketches.rank_error()
    )


def q_sketched_distinct(spark, sf):
    """Distinct zones from merged monthly HLL sketches, beside the exact
    numbers."""
    store, silver = _sketched(spark, sf), _silver(spark, sf)
    found = [
        sketches.merged_distinct(store, key).withColumn("exact", silver.agg(F.count_distinct(key)).scalar())
        for key in sketches.KEYS
    ]
    error = F.abs(F.col("distinct_values") - F.col("exact")) <= F.col("exact") * sketches.distinct_error()
    return found[0].unionByName(found[1]).select("key", "exact", error.alias("within_bound"))


# -- streaming -------------------------------------------------------------------

def q_window_alerts_batch(spark, sf):
    """R1 (batch form): (zone, clock hour) cells reaching the p90."""
    return stream_alerts.batch_window_alerts(read_table(spark, sf, "events"))


def q_stream_demand_alerts(spark, sf):
    """The same alerts produced by a Structured Streaming query over
    the events file (bounded availableNow run)."""
    history = read_table(spark, sf, "events")
    return stream_alerts.run_alert_stream(spark, history, sf, "events.parquet")


def _arrivals(spark, sf, n=3):
    """The events in ``n`` deliveries, a file each, of which every one covers
    the whole time: most of the later ones are behind the watermark."""
    events = read_table(spark, sf, "events")
    source = scratch_dir(spark, "arrivals")
    for k in range(n):
        part = events.where(F.pmod(F.col("event_id"), F.lit(n)) == k) if k else events.where(
            F.col("event_id").isNull() | (F.pmod(F.col("event_id"), F.lit(n)) == 0)
        )
        part.coalesce(1).write.mode("append").parquet(source)
    return events, source


def q_reconciled_stream_alerts(spark, sf):
    """Alerts of a stream most of whose rows come behind its watermark,
    after the reconciliation with the ledger of late rows."""
    events, source = _arrivals(spark, sf)
    store, sink, counts, ledger = (scratch_dir(spark, f"late-{n}") for n in ("limit", "sink", "counts", "ledger"))
    limit = stream_alerts.window_threshold(events).first()["threshold"]
    if limit is None:
        return spark.createDataFrame([], stream_alerts.ALERT_SCHEMA)
    late.store_threshold(spark, store, limit)
    for query in (
        stream_alerts.start_alert_stream(
            spark, source, store, sink, scratch_dir(spark, "late-ckpt-a"), max_files_per_trigger=1, counts_dir=counts, state_partitions=8
        ),
        late.start_ledger_stream(spark, source, ledger, scratch_dir(spark, "late-ckpt-b"), max_files_per_trigger=1),
    ):
        query.awaitTermination()
    return late.reconciled(spark, ledger, counts).where(F.col("trip_count") >= limit).drop("late_rows")


def q_stream_alert_episodes(spark, sf):
    """Runs of consecutive alerting hours of a zone, finished ones from a
    session-window stream over the alerts."""
    alerts = stream_alerts.batch_window_alerts(read_table(spark, sf, "events"))
    stored, episodes = scratch_dir(spark, "episode-alerts"), scratch_dir(spark, "episodes")
    alerts.withColumn("batch_id", F.lit(0).cast("bigint")).write.mode("overwrite").parquet(stored)
    late.start_episode_stream(spark, stored, episodes, scratch_dir(spark, "episodes-ckpt"), state_partitions=8).awaitTermination()
    return late.read_episodes(spark, stored, episodes)


QUERIES: dict[str, Query] = {
    # sources and sinks
    "scan_raw": _q(q_scan_raw, keep=True),
    "scan_zones": _q(q_scan_zones, keep=True),
    "write_silver": _q(q_write_silver, keep=True),
    "bronze_clone": _q(q_bronze_clone, keep=True),
    "refreshed_zone_features": _q(q_refreshed_zone_features),
    "refreshed_heatmap": _q(q_refreshed_heatmap),
    "write_hourly_demand": _q(q_write_hourly_demand),
    "write_dow_demand": _q(q_write_dow_demand),
    "write_gold": _q(q_write_gold),
    "write_recommendations": _q(q_write_recommendations),
    # cleaning
    "clean_trips": _q(q_clean_trips, keep=True),
    "clean_trips_events": _q(q_clean_trips_events, keep=True),
    "cleaning_funnel": _q(q_cleaning_funnel),
    "cleaning_funnel_events": _q(q_cleaning_funnel_events),
    "filter_distance": _q(q_filter_distance, keep=True),
    "filter_duration": _q(q_filter_duration, keep=True),
    "filter_total_amount": _q(q_filter_total_amount, keep=True),
    "filter_locations": _q(q_filter_locations, keep=True),
    "derive_features": _q(q_derive_features, keep=True),
    "filter_speed": _q(q_filter_speed, keep=True),
    "speed_sanity": _q(q_speed_sanity, keep=True),
    # demand
    "hourly_demand": _q(_on_silver(demand.hourly_demand)),
    "hourly_demand_events": _q(_on_silver(demand.hourly_demand, "events")),
    "dow_demand": _q(_on_silver(demand.dow_demand)),
    "hour_dow_heatmap": _q(_on_silver(demand.hour_dow_heatmap)),
    "temporal_demand": _q(_on_silver(demand.temporal_demand)),
    "top_pickup_zones": _q(_on_silver(demand.top_pickup_zones)),
    "top_pickup_zones_events": _q(_on_silver(demand.top_pickup_zones, "events")),
    "top_zones_all": _q(q_top_zones_all),
    "rush_hour_trips": _q(q_rush_hour_trips, keep=True),
    "rush_hour_hotspots": _q(_on_silver(demand.rush_hour_hotspots)),
    "hourly_zone_demand": _q(_on_silver(demand.hourly_zone_demand)),
    "dow_demand_named": _q(_on_silver(demand.dow_demand_named)),
    "heatmap_named": _q(_on_silver(demand.heatmap_named)),
    "hourly_per_day": _q(_on_silver(demand.hourly_per_day)),
    "hourly_avg_demand": _q(_on_silver(demand.hourly_avg_demand)),
    "hourly_avg_demand_events": _q(_on_silver(demand.hourly_avg_demand, "events")),
    "monthly_demand": _q(_on_silver(demand.monthly_demand)),
    # zones
    "zone_features": _q(_on_silver(zones.zone_features)),
    "zone_count": _q(q_zone_count),
    "zone_names": _q(q_zone_names),
    "top_zones_named": _q(q_top_zones_named),
    "top_zones_named_all": _q(q_top_zones_named_all),
    "top_zones_named_events": _q(q_top_zones_named_events),
    # cluster insights on the demand-band gold
    "gold_demand_bands": _q(q_gold_demand_bands),
    "cluster_keys": _q(q_cluster_keys),
    "cluster_summary": _q(_on_gold(insights.cluster_summary)),
    "cluster_summary_chart": _q(_on_gold(insights.cluster_summary_chart)),
    "zones_by_cluster": _q(_on_gold(insights.zones_by_cluster)),
    "trips_threshold": _q(_on_gold(insights.trips_threshold)),
    "hotspots": _q(_on_gold(insights.hotspots)),
    "trips_with_cluster": _q(_on_silver_gold(insights.trips_with_cluster), keep=True),
    "trips_with_cluster_bucketed": _q(_on_silver_gold(q_trips_with_cluster_bucketed), keep=True),
    "cluster_hourly_demand": _q(_on_silver_gold(insights.cluster_hourly_demand)),
    "demand_threshold": _q(_on_silver(insights.demand_threshold)),
    "demand_alerts": _q(_on_silver(insights.demand_alerts)),
    "demand_alerts_events": _q(q_demand_alerts_events),
    "recommendations": _q(_on_gold(insights.recommendations)),
    "top_zones_per_cluster": _q(_on_gold(insights.top_zones_per_cluster)),
    "cluster_roles": _q(_on_gold(insights.cluster_roles)),
    "cluster_peak_hours": _q(_on_silver_gold(insights.cluster_peak_hours)),
    "cluster_daypart_share": _q(_on_silver_gold(insights.cluster_daypart_share)),
    "cluster_recommendations": _q(_on_silver_gold(insights.cluster_recommendations)),
    # clustering
    "assemble_features": _q(q_assemble_features),
    "scaled_features": _q(q_scaled_features),
    "write_gold_vectors": _q(q_write_gold_vectors),
    "silhouette": _q(q_silhouette),
    "kmeans_assign": _q(q_kmeans_assign),
    "kmeans_sweep": _q(q_kmeans_sweep),
    "gold_kmeans": _q(q_gold_kmeans),
    "kmeans_cluster_summary": _q(q_kmeans_cluster_summary),
    # profiling
    "row_count": _q(q_row_count),
    "preview": _q(q_preview, keep=True),
    "schema_profile": _q(q_schema_profile, keep=True),
    "data_profile": _q(q_data_profile, keep=("min", "max")),
    "distribution_summary": _q(q_distribution_summary, keep=("value",)),
    "distance_histogram": _q(q_distance_histogram),
    "feature_correlation": _q(q_feature_correlation),
    "rank_correlation": _q(q_rank_correlation),
    "sketched_quantiles": _q(q_sketched_quantiles),
    "sketched_distinct": _q(q_sketched_distinct),
    # streaming
    "window_alerts_batch": _q(q_window_alerts_batch),
    "stream_demand_alerts": _q(q_stream_demand_alerts),
    "reconciled_stream_alerts": _q(q_reconciled_stream_alerts),
    "stream_alert_episodes": _q(q_stream_alert_episodes),
}
