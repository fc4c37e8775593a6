"""Late rows put back, thresholds read anew per micro-batch, alert episodes."""

import datetime as dt
import os

from pyspark.sql import functions as F

from test_streaming import write_events
from zonepulse.streaming import alerts, late

T = dt.datetime(2024, 1, 1)


def folders(tmp_dir, *names):
    made = [os.path.join(tmp_dir, n) for n in names]
    os.makedirs(made[0])
    return made


def test_late_rows_are_counted_and_put_back(spark, tmp_dir):
    src, sink, ckpt, counts, ledger, ckpt2 = folders(tmp_dir, "src", "sink", "ckpt", "counts", "ledger", "ckpt2")
    first = [(1, T.replace(hour=10, minute=5), 1), (2, T.replace(hour=10, minute=50), 1), (3, T.replace(day=4, hour=12), 2)]
    second = [(4, T.replace(hour=10, minute=10), 1), (5, T.replace(hour=9), 1), (6, T.replace(day=4, hour=12, minute=1), 2), (7, T, None)]
    for name, rows in (("a", first), ("b", second)):  # the second delivery is days late
        write_events(os.path.join(src, f"{name}.parquet"), rows)
        alerts.start_alert_stream(spark, src, 2, sink, ckpt, counts_dir=counts).awaitTermination()
        late.start_ledger_stream(spark, src, ledger, ckpt2).awaitTermination()
    got = {(r["pickup_location_id"], r["window_start"].day, r["window_start"].hour): (r["trip_count"], r["late_rows"]) for r in late.reconciled(spark, ledger, counts).collect()}
    assert got == {(1, 1, 10): (3, 1), (1, 1, 9): (1, 1), (2, 4, 12): (2, 0)}
    batch = alerts._present(alerts.window_counts(alerts.pickups(spark.read.schema(alerts.EVENT_SCHEMA).parquet(src))))
    assert sorted(map(tuple, late.window_totals(spark, ledger).collect())) == sorted(map(tuple, batch.select(late.window_totals(spark, ledger).columns).collect()))


def test_a_threshold_stored_mid_stream_counts_from_the_next_batch(spark, tmp_dir):
    src, sink, ckpt, store = folders(tmp_dir, "src", "sink", "ckpt", "limits")
    assert late.newest_threshold(spark, store) is None
    for n, limit in enumerate((3, 2, None)):
        if limit:
            assert late.store_threshold(spark, store, limit) == n + 1
        write_events(os.path.join(src, f"{n}.parquet"), [(10 * n + i, T.replace(hour=10 + n, minute=i), n + 1) for i in range(2)])
        alerts.start_alert_stream(spark, src, store, sink, ckpt).awaitTermination()
    got = sorted((r["pickup_location_id"], r["trip_count"]) for r in alerts.read_alerts(spark, sink).collect())
    assert got == [(2, 2), (3, 2)]  # two trips were too few under the first threshold


def test_no_threshold_no_alert(spark, tmp_dir):
    src, sink, ckpt, store = folders(tmp_dir, "src", "sink", "ckpt", "limits")
    write_events(os.path.join(src, "a.parquet"), [(1, T, 1)])
    alerts.start_alert_stream(spark, src, store, sink, ckpt).awaitTermination()
    assert alerts.read_alerts(spark, sink).count() == 0


def test_episodes(spark, tmp_dir):
    hours = [(1, 3, 5), (1, 4, 9), (1, 5, 6), (1, 7, 5), (2, 4, 5), (1, 4, 8)]  # hour 4 was reported twice
    rows = [(z, T.replace(hour=h), T.replace(hour=h + 1), n, 0) for z, h, n in hours] + [(9, T.replace(day=9), T.replace(day=9, hour=1), 7, 1)]
    frame = spark.createDataFrame(rows, late.LEDGER_SCHEMA)
    want = [
        (1, T.replace(hour=3), T.replace(hour=6), 3, 9),
        (1, T.replace(hour=7), T.replace(hour=8), 1, 5),
        (2, T.replace(hour=4), T.replace(hour=5), 1, 5),
        (9, T.replace(day=9), T.replace(day=9, hour=1), 1, 7),
    ]
    assert sorted(map(tuple, late.alert_episodes(frame).collect())) == want
    stored, episodes, ckpt = (os.path.join(tmp_dir, n) for n in ("alerts", "episodes", "ckpt"))
    frame.write.parquet(stored)
    late.start_episode_stream(spark, stored, episodes, ckpt, state_partitions=2).awaitTermination()
    done = spark.read.schema(late.EPISODE_SCHEMA).parquet(episodes)
    assert sorted(map(tuple, done.collect())) == want[:3]  # the last is still open
    assert sorted(map(tuple, late.read_episodes(spark, stored, episodes).collect())) == want


def test_episodes_of_nothing(spark):
    empty = spark.createDataFrame([], alerts.ALERT_SCHEMA)
    assert late.alert_episodes(empty).agg(F.count("*")).first()[0] == 0
