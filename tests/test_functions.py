"""Column helpers: weekday labels and order, epoch arithmetic independent
of the session time zone, calendar parts, quantile variants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonepulse.functions import (
    epoch_seconds,
    instant_from_ntz,
    ntz_from_instant,
    threshold_frame,
    time_parts,
    label_weekdays,
    weekday_position,
)


def test_weekday_labels_and_positions(spark):
    df = spark.createDataFrame([(d, 1 + (d or 0)) for d in (0, 6, 7, -1, None, 0)], "day_of_week int, n long")
    out = label_weekdays(df, "n").select("day_name", "n", weekday_position().alias("p")).collect()
    assert {(r.day_name, r.n, r.p) for r in out} == {("Mon", 2, 1), ("Sun", 7, 7), (None, 9, None)}


@pytest.mark.parametrize("tz", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_arithmetic_ignores_session_time_zone(spark, tz):
    ts = dt.datetime(2024, 3, 10, 2, 30, 15, 999_999)  # inside a DST gap in New York
    df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")  # built under the UTC test session
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        row = df.select(
            epoch_seconds("ts").alias("s"), ntz_from_instant(instant_from_ntz("ts")).alias("back")
        ).first()
        assert row.s == int(dt.datetime(2024, 3, 10, 2, 30, 15, tzinfo=dt.timezone.utc).timestamp())
        assert row.back == ts
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_time_parts_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 5),)], "ts timestamp_ntz")  # a Monday
    row = df.select(*[c.alias(n) for n, c in time_parts("ts").items()]).first()
    assert (row.year, row.month, row.day, row.day_of_week, row.hour_of_day) == (2024, 1, 1, 0, 23)


def test_approximate_threshold_variant(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 101)], "x bigint")
    exact = threshold_frame(df, "x", 0.75).first()[0]
    approx = threshold_frame(df, "x", 0.75, relative_error=0.01).first()[0]
    assert exact == 75
    assert abs(approx - exact) <= 1
    assert threshold_frame(df.filter(F.lit(False)), "x", 0.75).first()[0] is None


def test_schema_profile_lists_columns_in_order(spark):
    from zonepulse.operators.profile import schema_profile

    df = spark.createDataFrame([(1, "a", 2.0)], "id bigint, name string, x double")
    rows = schema_profile(spark, df).orderBy("position").collect()
    assert [(r.column, r.position, r.data_type) for r in rows] == [
        ("id", 0, "bigint"),
        ("name", 1, "string"),
        ("x", 2, "double"),
    ]


def test_session_settings_for_local_and_cluster():
    from zonepulse.session import CLUSTER_CONF, session_settings

    local = session_settings("local[8]", 16)
    assert local["spark.sql.adaptive.enabled"] == "true"
    assert local["spark.sql.shuffle.partitions"] == "16"
    assert "spark.sql.files.maxPartitionBytes" not in local
    cluster = session_settings(None, conf={"spark.sql.shuffle.partitions": "8000"})
    assert cluster["spark.sql.files.maxPartitionBytes"] == CLUSTER_CONF["spark.sql.files.maxPartitionBytes"]
    assert cluster["spark.sql.shuffle.partitions"] == "8000"  # explicit values win
    assert local["spark.ui.enabled"] == "false"
    assert "spark.ui.enabled" not in cluster  # the cluster's own setting holds
