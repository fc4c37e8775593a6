"""J2 over bucketed layers: rows, plan without an exchange, split hot zones."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from zonepulse.operators import insights
from zonepulse.plans import buckets, inputs


@pytest.fixture()
def sides(spark):
    facts = spark.range(0, 6_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50).cast("int").alias("zone"),
        "id",
    )
    dim = spark.range(0, 40).select(F.col("id").alias("z"), (F.col("id") * 10).alias("label"))
    return facts, dim.unionByName(spark.createDataFrame([(1 << 40, 5)], "z long, label long"))


def joined(sides, how="left", **bounds):
    facts, dim = sides
    layer, right = buckets.scratch_tables(facts, "zone", dim, "z", 8, **bounds)
    return layer, buckets.bucketed_join(layer, right, "z", how)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("bound", [300, 10**6])
def test_equals_the_plain_join(sides, how, bound):
    facts, dim = sides
    plain = facts.join(dim, facts.zone == dim.z, how).select("zone", "id", "label")
    _, got = joined(sides, how, rows_per_part=bound)
    assert got.columns == ["zone", "id", "label"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_no_exchange_whatever_the_size(spark, sides):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(joined(sides, rows_per_part=300)[1])
        assert "SortMergeJoin LeftOuter" in text and "Exchange" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_a_hot_zone_is_split_and_null_keys_are_spread(sides):
    layer, _ = joined(sides, rows_per_part=300)
    facts = layer.facts()
    assert facts.where("zone = 7").groupBy(buckets.PART).count().count() > 5
    fullest = [r["count"] for r in facts.groupBy(F.input_file_name()).count().collect()]
    assert len(fullest) <= 8 and max(fullest) < 2_000 and sum(fullest) == 6_000
    nulls = facts.where("zone IS NULL").groupBy(F.input_file_name()).count().collect()
    assert len(nulls) > 4


def test_empty_sides_and_the_reserved_name(spark, sides):
    facts, dim = sides
    _, none = joined((facts.limit(0), dim))
    assert none.count() == 0
    _, alone = joined((facts, dim.limit(0)))
    assert alone.count() == 6_000 and alone.where("label IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="part column"):
        buckets.write_bucketed(facts.withColumnRenamed("id", buckets.PART), "t", "zone", 4)


def test_a_layer_serves_several_dimensions(spark):
    silver, gold = inputs.silver_trips(spark, SF_SMALL), inputs.demand_band_gold(spark, SF_SMALL)
    key = "pickup_location_id"
    layer, first = buckets.scratch_tables(silver, key, insights.cluster_keys(gold), key, 8, rows_per_part=50)
    other = buckets.write_bucketed_dimension(layer, gold.select(key, "zone_name"), f"{layer.table}_names", key)
    assert buckets.bucketed_join(layer, first, key).count() == silver.count()
    named = buckets.bucketed_join(layer, other, key)
    assert named.where("zone_name IS NOT NULL").count() == silver.join(gold.select(key), key, "left_semi").count()
