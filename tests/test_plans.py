"""Physical-plan properties that matter at scale, checked on the plans
Spark actually chooses (``DataFrame.explain`` output)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, plan_text
from zonepulse.operators import demand, insights
from zonepulse.plans import inputs
from zonepulse.plans.joins import dimension_join
from zonepulse.plans.registry import QUERIES


def tree(df):
    text = plan_text(df)
    return text.split("\n\n")[0]


def test_cluster_demand_aggregates_before_the_join(spark):
    silver, gold = inputs.silver_trips(spark, SF_MID), inputs.demand_band_gold(spark, SF_MID)
    lines = tree(insights.cluster_hourly_demand(silver, gold)).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert "BroadcastHashJoin" in lines[join]
    assert "HashAggregate" in lines[join + 1], "trips must be aggregated to cells before the join"


def test_checked_small_dimension_is_broadcast(spark):
    silver, gold = inputs.silver_trips(spark, SF_MID), inputs.demand_band_gold(spark, SF_MID)
    text = tree(insights.trips_with_cluster(silver, gold))
    assert "BroadcastHashJoin LeftOuter" in text
    assert "SortMergeJoin" not in text


def test_large_dimension_path_salts_hot_keys(spark):
    facts = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 != 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"), F.col("id")
    )
    dim = spark.range(0, 40).select(F.col("id").alias("zone_id"), (F.col("id") * 10).alias("label"))
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = dimension_join(facts, dim, "k", "zone_id", "left", max_rows=0, rows_per_salt=500)
        text = plan_text(joined)
        assert "SortMergeJoin LeftOuter" in text and "_salt" in text
        # only the counted table of hot keys is broadcast, to either side
        assert tree(joined).count("BroadcastHashJoin") == 2 and "_hot_key" in text
        assert joined.count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_top_n_per_group_limits_before_the_shuffle(spark):
    text = tree(insights.top_zones_per_cluster(inputs.demand_band_gold(spark, SF_SMALL), 3))
    assert "WindowGroupLimit" in text


def test_alert_threshold_is_a_subquery_not_a_join(spark):
    text = plan_text(insights.demand_alerts(inputs.silver_trips(spark, SF_SMALL)))
    assert "Subquery" in text and "Join" not in tree(insights.demand_alerts(inputs.silver_trips(spark, SF_SMALL)))


def test_temporal_demand_expands_cells_not_trips(spark):
    text = tree(demand.temporal_demand(inputs.silver_trips(spark, SF_SMALL)))
    assert text.count("Scan parquet") == 1
    below = text[text.index("Expand") :]
    assert "Exchange" in below and "HashAggregate" in below  # the trips are counted first


def test_labels_meet_counts_not_trips(spark):
    for name in ("dow_demand_named", "heatmap_named"):
        text = tree(QUERIES[name](spark, SF_SMALL))
        assert text.count("Scan parquet") == 1 and "Expand" not in text
        assert text.count("HashAggregate") == 4  # by number, then by label


def test_next_event_lookup_shuffles_the_events_once_after_the_copy(spark):
    from zonepulse.sources.adapters import next_event_time
    from zonepulse.sources.tables import read_table

    text = plan_text(next_event_time(read_table(spark, SF_SMALL, "events"), partitions=4), "simple")
    assert text.count("REPARTITION_BY_NUM") == 1
    # the other exchange carries one partial minimum per task and partition
    assert text.count("Exchange hashpartitioning(_pid") == 2 and text.count("partial_min(") == 1


def test_top_zones_do_not_shuffle_the_dimension(spark):
    text = plan_text(QUERIES["top_zones_named"](spark, SF_SMALL), "simple")
    semi = text[text.index("LeftSemi") :]
    dimension = semi[semi.index("supplier") - 2_000 if "supplier" in semi else 0 :]
    assert "BroadcastHashJoin" in text
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    assert not any("Exchange hashpartitioning(zone_id" in line for line in lines[at:]), dimension


SKIP = {"stream_demand_alerts"}  # starts a stream; its batch twin is checked


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SKIP))
def test_no_query_plans_a_cartesian_or_nested_loop_join(spark, name):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
