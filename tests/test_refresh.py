"""Refresh by day equals a full rebuild and touches only the delivered days."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from zonepulse.operators import demand
from zonepulse.operators.clean import clean_trips
from zonepulse.operators.zones import demand_cells, zone_features
from zonepulse.plans import inputs, refresh


def rows(df):
    """Doubles as printed with nine digits; sums differ in the last bits."""
    cols = sorted(df.columns)
    return sorted(str([f"{v:.9g}" if isinstance(v, float) else v for v in r]) for r in df.select(*cols).collect())


def few_days(spark):
    """Whole trips, dated into two weeks."""
    raw = inputs.raw_trips(spark, SF_SMALL)
    return raw.withColumn("day", (F.col("day") % 7 + 1).cast("int")).withColumn("month", (F.col("month") % 2).cast("int")).withColumn("year", F.lit(2020))


def day_folders(store):
    out = {}
    for root, _, names in os.walk(store):
        files = sorted(n for n in names if n.endswith(".parquet"))
        if files:
            out[root] = files
    return out


def test_an_added_and_a_corrected_day_equal_a_rebuild(spark, tmp_dir):
    raw = few_days(spark)
    days = [tuple(r) for r in raw.select("year", "month", "day").distinct().orderBy("year", "month", "day").collect()]
    new, fixed = days[-1], days[len(days) // 2]
    of = lambda d: (F.col("year") == d[0]) & (F.col("month") == d[1]) & (F.col("day") == d[2])
    store = os.path.join(tmp_dir, "cells")
    wrong = raw.where(~of(new)).withColumn("fare_amount", F.when(of(fixed), F.lit(9999.0)).otherwise(F.col("fare_amount")))
    refresh.refresh(wrong.unionByName(wrong.where(of(fixed))), store)
    before = day_folders(store)
    stored = refresh.refresh(raw.where(of(new) | of(fixed)), store)
    after = day_folders(store)
    touched = {p for p in after if before.get(p) != after[p]}
    assert len(touched) == 2 and set(before) <= set(after) and len(after) == len(days)
    silver = clean_trips(raw)
    merged = refresh.merged_cells(stored)
    assert rows(merged) == rows(demand_cells(silver))
    assert rows(zone_features(merged)) == rows(zone_features(silver))
    for table in (demand.hourly_demand, demand.dow_demand, demand.hour_dow_heatmap):
        assert rows(table(merged)) == rows(table(silver))


def test_a_day_whose_trips_are_all_withdrawn_or_undated(spark, tmp_dir):
    raw = few_days(spark)
    store = os.path.join(tmp_dir, "cells")
    one = raw.select("year", "month", "day").distinct().orderBy("year", "month", "day").first()
    of = (F.col("year") == one[0]) & (F.col("month") == one[1]) & (F.col("day") == one[2])
    undated = raw.limit(50).withColumn("day", F.lit(None).cast(dict(raw.dtypes)["day"]))
    refresh.refresh(raw.unionByName(undated), store)
    refresh.refresh(raw.where(of).withColumn("trip_distance", F.lit(-1.0)), store)
    stored = refresh.refresh(undated, store)  # twice the same: no change
    want = demand_cells(clean_trips(raw.where(~of).unionByName(undated)))
    assert rows(refresh.merged_cells(stored)) == rows(want)


def test_an_empty_delivery_changes_nothing(spark, tmp_dir):
    raw = few_days(spark)
    store = os.path.join(tmp_dir, "cells")
    refresh.refresh(raw, store)
    before = day_folders(store)
    stored = refresh.refresh(raw.limit(0), store)
    assert day_folders(store) == before and stored.agg(F.sum("trip_count")).first()[0] == clean_trips(raw).count()
