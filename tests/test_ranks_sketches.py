"""Rank correlation against pandas; sketches by day against exact counts."""

import math
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from zonepulse.operators import ranks
from zonepulse.operators.clean import clean_trips
from zonepulse.plans import inputs, refresh, sketches

COLUMNS = ("a", "b", "c")


def frame(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, c bigint")


def tied(n=900):
    """A third of all rows share one value of ``a``; some lack a value."""
    rows = [(0.0 if i % 3 == 0 else float(i * 7919 % 311), float(i * i % 97) - 40.0, i % 5) for i in range(n)]
    return rows + [(None, 1.0, 1), (1.0, math.nan, 1), (1.0, 1.0, None), (-0.0, 5.0, 2), (math.inf, -math.inf, 9)]


def by_pair(df):
    return {(r.left, r.right): r.corr for r in df.collect()}


@pytest.mark.parametrize("partitions, max_rows", [(1, 10**6), (7, 10**6), (7, 0)])
def test_spearman_equals_pandas_on_ties_and_gaps(spark, partitions, max_rows):
    df = frame(spark, tied()).repartition(3)
    got = by_pair(ranks.rank_correlation(df, COLUMNS, partitions, max_rows))
    cases = df.toPandas().dropna()
    want = cases.rank(method="average").corr()
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    for (x, y), rho in got.items():
        assert rho == pytest.approx(want.loc[x, y], abs=1e-12)


def test_mean_ranks_do_not_depend_on_the_partitions(spark):
    df = frame(spark, tied())
    one, many = (sorted(map(tuple, ranks.mean_ranks(df, "a", p).collect())) for p in (1, 16))
    pandas = df.toPandas()["a"].dropna()
    assert one == many == sorted({(v, r) for v, r in zip(pandas, pandas.rank(method="average"))})


def test_no_rows_and_constant_columns_give_null(spark):
    assert set(by_pair(ranks.rank_correlation(frame(spark, []), COLUMNS)).values()) == {None}
    got = by_pair(ranks.rank_correlation(frame(spark, [(1.0, float(i), i) for i in range(5)]), COLUMNS))
    assert got == {("a", "b"): None, ("a", "c"): None, ("b", "c"): pytest.approx(1.0)}


def test_no_window_over_a_single_partition(spark):
    plan = plan_text(ranks.mean_ranks(frame(spark, tied()), "a", 4))
    assert "Window" in plan and "SinglePartition" not in plan


def dated(spark):
    return inputs.raw_trips(spark, SF_SMALL).withColumn("day", (F.col("day") % 5 + 1).cast("int")).withColumn("month", F.lit(1)).withColumn("year", F.lit(2020))


def test_merged_sketches_stay_within_their_bounds(spark, tmp_dir):
    raw = dated(spark)
    silver = clean_trips(raw)
    store = sketches.refresh_sketches(raw, os.path.join(tmp_dir, "s"))
    assert store.count() == raw.select("year", "month", "day").distinct().count()
    checked = sketches.measured_quantiles(store, silver, sketches.MEASURES, (0.0, 0.1, 0.5, 0.9, 1.0), sketches.rank_error()).collect()
    assert len(checked) == 15 and all(r.within_bound for r in checked)
    whole = sketches.unit_sketches(silver.withColumn("day", F.lit(1)))
    for key in sketches.KEYS:
        exact = silver.select(key).distinct().count()
        merged, single = (sketches.merged_distinct(x, key).first().distinct_values for x in (store, whole))
        assert abs(merged - exact) <= sketches.distinct_error() * exact
        assert abs(merged - single) <= sketches.distinct_error() * exact


def test_a_corrected_day_replaces_its_sketches_alone(spark, tmp_dir):
    raw, path = dated(spark), os.path.join(tmp_dir, "s")
    fixed = F.col("day") == 3
    wrong = raw.withColumn("trip_distance", F.when(fixed, F.lit(99.0)).otherwise(F.col("trip_distance")))
    top = lambda s: sketches.merged_quantiles(s, "trip_distance", [1.0]).first()
    assert top(sketches.refresh_sketches(wrong, path)).value == 99.0
    stored = sketches.refresh_sketches(raw.where(fixed), path)
    silver = clean_trips(raw)
    assert tuple(top(stored)) == ("trip_distance", 1.0, silver.agg(F.max("trip_distance")).first()[0], silver.count())
    # A day whose trips are all withdrawn leaves a row without sketches.
    stored = sketches.refresh_sketches(raw.where(fixed).withColumn("trip_distance", F.lit(-1.0)), path)
    assert top(stored).n == silver.where(~fixed).count() and stored.where(fixed).first().kll_trip_distance is None


def test_sketches_of_nothing(spark, tmp_dir):
    store = sketches.refresh_sketches(dated(spark).withColumn("trip_distance", F.lit(-1.0)), os.path.join(tmp_dir, "s"))
    assert [tuple(r) for r in sketches.merged_quantiles(store, "fare_amount", [0.5]).collect()] == [("fare_amount", 0.5, None, 0)]
    assert sketches.merged_distinct(store, "pickup_location_id").first().distinct_values == 0
    none = store.limit(0)
    assert sketches.merged_quantiles(none, "fare_amount", [0.5]).first().value is None


def test_refresh_and_sketches_share_units(spark):
    assert sketches.DAY == refresh.DAY
