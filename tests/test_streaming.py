"""The Structured Streaming alerts equal the batch alerts, and a row
later than the watermark is dropped."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq

from conftest import SF_SMALL
from zonepulse.sources.tables import read_table
from zonepulse.streaming import alerts


def rows_of(df):
    return sorted(tuple(r) for r in df.select("pickup_location_id", "window_start", "window_end", "trip_count").collect())


def test_stream_equals_batch(spark):
    events = read_table(spark, SF_SMALL, "events")
    batch = alerts.batch_window_alerts(events)
    streamed = alerts.run_alert_stream(spark, events, SF_SMALL, "events.parquet")
    assert rows_of(streamed) == rows_of(batch)
    assert len(rows_of(batch)) > 0


def write_events(path, rows):
    table = pa.table(
        {
            "event_id": pa.array([r[0] for r in rows], pa.int64()),
            "ts": pa.array([r[1] for r in rows], pa.timestamp("us")),
            "user_id": pa.array([r[2] for r in rows], pa.int64()),
            "event_type": pa.array(["view"] * len(rows), pa.string()),
            "value": pa.array([1.0] * len(rows), pa.float64()),
            "props": pa.array(['{"k": 1}'] * len(rows), pa.string()),
        }
    )
    pq.write_table(table, path)


def test_late_rows_beyond_watermark_are_dropped(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    os.makedirs(src)
    t = dt.datetime(2024, 1, 1)
    write_events(
        os.path.join(src, "a.parquet"),
        [(1, t.replace(hour=10, minute=5), 1), (2, t.replace(hour=10, minute=50), 1), (3, t.replace(hour=12, minute=30), 1)],
    )
    q = alerts.start_alert_stream(spark, src, 1, sink, ckpt)
    q.awaitTermination()
    # watermark is now 12:30 - 2h = 10:30: a 09:10 row is late, 12:40 is on time
    write_events(
        os.path.join(src, "b.parquet"),
        [(4, t.replace(hour=9, minute=10), 1), (5, t.replace(hour=12, minute=40), 1)],
    )
    q = alerts.start_alert_stream(spark, src, 1, sink, ckpt)
    q.awaitTermination()
    got = {r["window_start"].hour: r["trip_count"] for r in alerts.read_alerts(spark, sink).collect()}
    assert got == {10: 2, 12: 2}  # no 09:00 window; one row per (zone, window)


def test_backlog_in_several_micro_batches_gives_the_same_alerts(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    os.makedirs(src)
    t = dt.datetime(2024, 1, 1)
    rows = []
    for f in range(4):  # four files, in time order, zones 1 and 2
        batch = [(f * 10 + i, t.replace(hour=10 + f, minute=i * 5), 1 + i % 2) for i in range(6)]
        write_events(os.path.join(src, f"part-{f}.parquet"), batch)
        rows += batch
    q = alerts.start_alert_stream(spark, src, 1, sink, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    streamed = rows_of(alerts.read_alerts(spark, sink))
    history = spark.read.schema(alerts.EVENT_SCHEMA).parquet(src)
    counts = alerts._present(alerts.window_counts(alerts.pickups(history)))
    assert streamed == rows_of(counts)
    assert len(streamed) == 8  # 4 hours x 2 zones


def test_stream_has_its_own_state_partitions_and_few_files(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    os.makedirs(src)
    t = dt.datetime(2024, 1, 1)
    for n in range(3):
        rows = [(n * 100 + i, t.replace(hour=n, minute=i % 60), i + 1) for i in range(100)]
        write_events(os.path.join(src, f"{n}.parquet"), rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        q = alerts.start_alert_stream(spark, src, 1, sink, ckpt, max_files_per_trigger=1, state_partitions=6, sink_files=2)
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert q.exception() is None
    assert len([d for d in os.listdir(os.path.join(ckpt, "state", "0")) if d.isdigit()]) == 6
    assert len([f for f in os.listdir(sink) if f.endswith(".parquet")]) <= 4 * 2  # three batches and one that only moves the watermark
    assert alerts.read_alerts(spark, sink).count() == 300
