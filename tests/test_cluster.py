"""K-Means clustering checked by invariants (labels are not comparable
with an SQL oracle): coverage, nearest-centre assignment, silhouette
range, best-K choice, reproducibility under other partitionings, guards."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from zonepulse.operators import cluster
from zonepulse.operators.zones import FEATURE_COLUMNS, zone_features
from zonepulse.plans import inputs


@pytest.fixture(scope="module")
def zone_frame(spark):
    return zone_features(inputs.silver_trips(spark, SF_MID))


def test_every_zone_labelled_and_nearest_centre(spark, zone_frame):
    clustered, sweep = cluster.cluster_zones(zone_frame, canonical_labels=False)
    rows = clustered.collect()
    assert len(rows) == zone_frame.count()
    labels = {r["prediction"] for r in rows}
    assert labels == set(range(sweep.best_k))
    centres = np.array(sweep.best_model.clusterCenters())
    for r in rows:
        x = np.array([r[c] for c in FEATURE_COLUMNS], dtype=float)
        d = ((centres - x) ** 2).sum(axis=1)
        assert d[r["prediction"]] <= d.min() + 1e-6 * max(1.0, d.min())


def test_sweep_scores_and_best_k(spark, zone_frame):
    _, sweep = cluster.cluster_zones(zone_frame)
    scores = [s for _, s in sweep.results]
    assert [k for k, _ in sweep.results] == list(cluster.K_RANGE)
    assert all(-1.0 <= s <= 1.0 for s in scores)
    best = max(sweep.results, key=lambda kv: kv[1])  # first max wins ties
    assert sweep.best_k == best[0]


def test_canonical_labels_rank_by_demand(spark, zone_frame):
    clustered, _ = cluster.cluster_zones(zone_frame)
    means = clustered.groupBy("prediction").agg(F.avg("total_trips").alias("m")).orderBy("prediction").collect()
    m = [r["m"] for r in means]
    assert m == sorted(m, reverse=True)


def test_reproducible_across_partitionings(spark, zone_frame):
    base, sweep_a = cluster.cluster_zones(zone_frame)
    a = {r["pickup_location_id"]: r["prediction"] for r in base.collect()}
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        other = zone_features(inputs.silver_trips(spark, SF_MID).repartition(7))
        again, sweep_b = cluster.cluster_zones(other)
        b = {r["pickup_location_id"]: r["prediction"] for r in again.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    assert a == b
    assert sweep_a.results == sweep_b.results


def test_any_number_of_fit_partitions_gives_the_same_model(spark, zone_frame):
    fits = [cluster.cluster_zones(zone_frame.repartition(k), partitions=parts) for k, parts in ((2, 1), (9, 8), (3, 64))]
    models = {(f[1].best_k, tuple(f[1].results), f[1].best_model) for f in fits}
    assert len(models) == 1  # K, silhouettes and centres to the last bit
    labels = [sorted((r["pickup_location_id"], r["prediction"]) for r in f[0].collect()) for f in fits]
    assert labels[0] == labels[1] == labels[2]


def test_seeds_are_distinct_points_and_prefixes(spark, zone_frame):
    vectors = cluster.assemble_features(cluster.stable_features(zone_frame))
    six = cluster.seed_centres(vectors, 6)
    assert len(set(six)) == 6 and cluster.seed_centres(vectors.repartition(5), 4) == six[:4]
    points = {tuple(r["features"].toArray()) for r in vectors.select("features").collect()}
    assert set(six) <= points
    assert cluster.seed_centres(vectors, 6, seed=1) != six


def test_lloyd_ends_where_centres_are_means(spark, zone_frame):
    vectors = cluster.assemble_features(cluster.stable_features(zone_frame))
    model = cluster.fit_kmeans(vectors, 3, max_iter=200)
    rows = model.transform(vectors).select("features", "prediction").collect()
    for i, centre in enumerate(model.clusterCenters()):
        mine = np.array([r["features"].toArray() for r in rows if r["prediction"] == i])
        assert np.allclose(mine.mean(axis=0), centre, rtol=1e-6)


def test_zones_with_null_features_stay_and_small_inputs_are_guarded(spark):
    rows = [(1, 10, 1.0, 5.0, 1.0, 10.0, 5.0), (2, 20, 2.0, None, 1.0, 11.0, 6.0), (3, 30, 3.0, 7.0, 1.0, 12.0, 7.0),
            (4, 31, 3.1, 7.1, 1.0, 12.1, 7.1)]
    df = spark.createDataFrame(
        rows,
        "pickup_location_id bigint, total_trips bigint, avg_trip_distance double, avg_fare_amount double, "
        "avg_tip_amount double, avg_speed double, avg_duration_min double",
    )
    clustered, sweep = cluster.cluster_zones(df, ks=(3, 4, 5, 6))
    got = {r["pickup_location_id"]: r["prediction"] for r in clustered.collect()}
    assert set(got) == {1, 2, 3, 4} and sweep.incomplete == 1
    assert [z for z, p in got.items() if p is None] == [2]  # a NULL fare: in no cluster, but kept
    # three points: K=3 is the only K that can be fitted
    assert [k for k, s in sweep.results if s is None] == [4, 5, 6]
    assert sweep.best_k == 3
    # fewer points than every K: falls back to one cluster per point
    tiny, sweep2 = cluster.cluster_zones(df.filter("pickup_location_id <= 2"), ks=(3, 4))
    assert {r["pickup_location_id"]: r["prediction"] for r in tiny.collect()} == {1: 0, 2: None}
    assert sweep2.best_k == 1
    # no complete zone at all
    none, sweep3 = cluster.cluster_zones(df.filter("pickup_location_id = 2"), ks=(3,))
    assert [r["prediction"] for r in none.collect()] == [None] and sweep3.incomplete == 1


def test_scaled_features_option(spark, zone_frame):
    clustered, sweep = cluster.cluster_zones(zone_frame, ks=(3,), scale=True)
    assert clustered.count() == zone_frame.count()
    assert sweep.results[0][1] is None or -1.0 <= sweep.results[0][1] <= 1.0
