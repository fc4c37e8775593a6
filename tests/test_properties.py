"""Property-based checks on generated inputs (few examples each: every
example runs Spark jobs)."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonepulse.functions.quantiles import threshold_frame
from zonepulse.operators import clean
from zonepulse.plans.joins import dimension_join
from zonepulse.sources.adapters import next_event_time

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

RAW_SCHEMA = (
    "trip_id bigint, trip_distance double, trip_duration bigint, pickup_location_id bigint, "
    "dropoff_location_id bigint, year int, month int, day int, day_of_week int, hour_of_day int, "
    "fare_amount double, tip_amount double, total_amount double"
)

distances = st.one_of(
    st.none(), st.just(float("nan")), st.sampled_from([0.0, 100.0, 0.01, 99.99]), st.floats(-5, 150)
)
durations = st.one_of(st.none(), st.sampled_from([0, 60, 61, 14399, 14400]), st.integers(-10, 20000))
ids = st.one_of(st.none(), st.integers(-2, 5))
amounts = st.one_of(st.none(), st.sampled_from([0.0, -1.0, 0.01]), st.floats(-5, 50))
raw_rows = st.lists(st.tuples(distances, durations, ids, ids, amounts), min_size=1, max_size=40)


@SETTINGS
@given(raw_rows)
def test_funnel_equals_sequential_filters(spark, rows):
    data = [
        (i, d, t, p, q, 2024, 1, 1, 0, 12, 5.0, 1.0, a) for i, (d, t, p, q, a) in enumerate(rows)
    ]
    raw = spark.createDataFrame(data, RAW_SCHEMA)
    funnel = clean.cleaning_funnel(raw).first()
    s1 = clean.filter_distance(raw)
    s2 = clean.filter_duration(s1)
    s3 = clean.filter_total_amount(s2)
    s4 = clean.filter_locations(s3)
    s5 = clean.drop_missing_speed(clean.derive_speed(clean.derive_durations(s4)))
    s6 = clean.filter_speed(s5)
    got = [funnel[c] for c in ("raw_rows", "after_distance", "after_duration", "after_amount",
                               "after_locations", "after_speed_present", "silver_rows")]
    assert got == [raw.count(), s1.count(), s2.count(), s3.count(), s4.count(), s5.count(), s6.count()]
    assert clean.clean_trips(raw).count() == got[-1]


events = st.lists(
    st.tuples(st.sampled_from([1, 1, 1, 2, 3]), st.integers(0, 50)), min_size=1, max_size=60
)


@SETTINGS
@given(events, st.integers(1, 9))
def test_next_event_equals_plain_window(spark, rows, parts):
    base = dt.datetime(2024, 5, 1)
    data = [(i, base + dt.timedelta(minutes=7 * m), u) for i, (u, m) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id bigint, ts timestamp_ntz, user_id bigint")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    expected = {r.event_id: r.n for r in df.select("event_id", F.lead("ts").over(w).alias("n")).collect()}
    got = {r.event_id: r.next_ts for r in next_event_time(df, partitions=parts).collect()}
    assert got == expected


@SETTINGS
@given(st.lists(st.integers(0, 30), max_size=50), st.sampled_from([0.1, 0.25, 0.5, 0.75, 0.9, 1.0]))
def test_percentile_disc_equals_brute_force(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    got = threshold_frame(df, "x", q).first()[0]
    if not values:
        assert got is None
    else:
        ordered = sorted(values)
        assert got == ordered[max(0, math.ceil(q * len(ordered)) - 1)]


@SETTINGS
@given(st.lists(st.sampled_from([7, 7, 7, 7, 1, 2, 3, None, 99]), min_size=1, max_size=80))
def test_salted_join_equals_plain_join(spark, keys):
    facts = spark.createDataFrame(list(enumerate(keys)), "trip_id bigint, k bigint")
    dim = spark.createDataFrame([(z, f"z{z}") for z in range(10)], "zone_id bigint, name string")
    salted = dimension_join(facts, dim, "k", "zone_id", "left", max_rows=0, rows_per_salt=3)
    plain = facts.join(dim, facts.k == dim.zone_id, "left").drop("zone_id")
    assert sorted(tuple(r) for r in salted.select("trip_id", "k", "name").collect()) == sorted(
        tuple(r) for r in plain.select("trip_id", "k", "name").collect()
    )


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(1, 4), st.integers(0, 23), st.integers(0, 59)), min_size=1, max_size=40),
    st.integers(1, 3),
)
def test_stream_equals_batch_over_files(spark, rows, per_trigger):
    import os
    import tempfile

    import pyarrow as pa
    import pyarrow.parquet as pq

    from zonepulse.streaming import alerts

    root = tempfile.mkdtemp(prefix="zonepulse-prop-stream-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    day = dt.datetime(2024, 2, 1)
    events = sorted((day.replace(hour=h, minute=m), u) for u, h, m in rows)
    chunks = [events[i:i + 7] for i in range(0, len(events), 7)]  # files arrive in time order
    for n, chunk in enumerate(chunks):
        table = pa.table({
            "event_id": pa.array([n * 100 + i for i in range(len(chunk))], pa.int64()),
            "ts": pa.array([t for t, _ in chunk], pa.timestamp("us")),
            "user_id": pa.array([u for _, u in chunk], pa.int64()),
            "event_type": pa.array(["view"] * len(chunk), pa.string()),
            "value": pa.array([1.0] * len(chunk), pa.float64()),
            "props": pa.array(['{"k": 1}'] * len(chunk), pa.string()),
        })
        pq.write_table(table, os.path.join(src, f"part-{n:03d}.parquet"))
    history = spark.read.schema(alerts.EVENT_SCHEMA).parquet(src)
    threshold = alerts.window_threshold(history).first()["threshold"]
    query = alerts.start_alert_stream(
        spark, src, int(threshold), os.path.join(root, "sink"), os.path.join(root, "ckpt"),
        max_files_per_trigger=per_trigger,
    )
    query.awaitTermination()
    streamed = sorted(tuple(r) for r in alerts.read_alerts(spark, os.path.join(root, "sink")).collect())
    batch = sorted(tuple(r) for r in alerts.batch_window_alerts(history).collect())
    assert streamed == batch
