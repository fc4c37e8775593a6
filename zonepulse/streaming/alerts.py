"""Live demand alerts with Structured Streaming.

A pickup event counts towards its zone's clock hour; a (zone, hour window)
raises an alert once its count reaches the threshold. The threshold is the
exact ``q``-quantile of the same per-(zone, clock hour) counts over the
batch history — the stream and the threshold must share a grain (the
batch alerts of ``insights.demand_alerts`` use hour-of-day across all days,
a different grain, so their threshold is not reused here).

State: ``groupBy(window, zone).count()`` with a watermark; rows later than
the watermark are dropped and a window's state is freed once the
watermark passes its end. Output mode ``update`` emits a window every
micro-batch in which it changes, so the sink (``foreachBatch``) appends the
alerting rows with their batch id and readers keep one row per
(zone, window) with the highest count — idempotent under batch replays.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonepulse.functions.calendar import instant_from_ntz, ntz_from_instant
from zonepulse.functions.quantiles import threshold_frame
from zonepulse.session import scratch_dir

# State partitions of the stream, fixed when it first starts (Spark keeps the
# number in the checkpoint), and files per micro-batch in the sink.
STATE_PARTITIONS = 32
SINK_FILES = 4
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WINDOW = "1 hour"
WATERMARK = "2 hours"
ALERT_QUANTILE = 0.90
NO_THRESHOLD = 2**63 - 1
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
ALERT_SCHEMA = "pickup_location_id bigint, window_start timestamp_ntz, window_end timestamp_ntz, trip_count bigint"


def pickups(events: DataFrame) -> DataFrame:
    """Pickup events with a valid zone; event time as a TIMESTAMP instant
    (needed for the watermark), reading NTZ wall clocks as UTC so windows
    do not depend on the session time zone."""
    ts = F.col("ts") if dict(events.dtypes)["ts"] == "timestamp" else instant_from_ntz("ts")
    return events.filter(F.col("user_id").isNotNull() & (F.col("user_id") > F.lit(0))).select(
        F.col("user_id").alias("pickup_location_id"), ts.alias("event_time")
    )


def window_counts(pickup_events: DataFrame, window: str = WINDOW, watermark: str | None = None) -> DataFrame:
    """Trips per (zone, tumbling window). Works on batch and streaming
    frames; ``watermark`` only matters for streams."""
    df = pickup_events.withWatermark("event_time", watermark) if watermark else pickup_events
    return df.groupBy(F.window("event_time", window).alias("w"), "pickup_location_id").agg(
        F.count(F.lit(1)).alias("trip_count")
    )


def _present(counts: DataFrame) -> DataFrame:
    return counts.select(
        "pickup_location_id",
        ntz_from_instant("w.start").alias("window_start"),
        ntz_from_instant("w.end").alias("window_end"),
        "trip_count",
    )


def window_threshold(events: DataFrame, q: float = ALERT_QUANTILE, window: str = WINDOW) -> DataFrame:
    """Exact ``q``-quantile of the per-(zone, window) counts (one row)."""
    return threshold_frame(window_counts(pickups(events), window), "trip_count", q, "threshold")


def batch_window_alerts(events: DataFrame, q: float = ALERT_QUANTILE, window: str = WINDOW) -> DataFrame:
    """The batch answer the stream must reproduce: every (zone, window)
    whose count reaches the threshold."""
    counts = window_counts(pickups(events), window)
    limit = threshold_frame(counts, "trip_count", q).scalar()
    return _present(counts.filter(F.col("trip_count") >= limit))


def start_alert_stream(
    spark: SparkSession,
    source_dir: str,
    threshold: int | str,
    sink_dir: str,
    checkpoint_dir: str,
    file_glob: str = "*.parquet",
    window: str = WINDOW,
    watermark: str = WATERMARK,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    schema: str = EVENT_SCHEMA,
    state_partitions: int = STATE_PARTITIONS,
    sink_files: int = SINK_FILES,
    counts_dir: str | None = None,
) -> StreamingQuery:
    """Start the alert stream over Parquet files arriving in ``source_dir``.

    ``threshold`` is a number, or the folder of stored thresholds, whose
    newest version is read anew in every micro-batch (no version: no alert).
    ``counts_dir`` keeps the counts of all changed windows, alerting or not,
    for the reconciliation with late rows (``streaming.late``).

    ``available_now`` processes what is there and stops (a bounded run);
    otherwise the query keeps running as new files arrive.
    ``max_files_per_trigger`` bounds the size of each micro-batch (a backlog
    is then worked off in several batches instead of one huge one).
    ``schema`` needs ``ts`` (TIMESTAMP_NTZ or TIMESTAMP) and ``user_id``.

    The stream has its own number of state partitions, not the session's
    shuffle partitions (thousands on a cluster, each a state store visited
    by every micro-batch); state lives in RocksDB, off the JVM heap, and
    each batch appends at most ``sink_files`` files. The settings hold in a
    session of the query's own.
    """
    spark = spark.newSession()
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    events = reader.parquet(source_dir)
    counts = window_counts(pickups(events), window, watermark)

    def emit(batch: DataFrame, batch_id: int) -> None:
        from zonepulse.streaming.late import newest_threshold

        now = newest_threshold(spark, threshold) if isinstance(threshold, str) else threshold
        if counts_dir:
            batch = batch.persist()
            every = _present(batch).withColumn("batch_id", F.lit(batch_id)).coalesce(sink_files)
            every.write.mode("append").parquet(counts_dir)
        # Without a threshold nothing alerts, but the batch must still be read
        # whole, as its state is kept by the tasks that read it.
        alerts = _present(batch.filter(F.col("trip_count") >= F.lit(NO_THRESHOLD if now is None else now)))
        alerts = alerts.withColumn("batch_id", F.lit(batch_id)).coalesce(sink_files)
        alerts.write.mode("append").parquet(sink_dir)
        batch.unpersist()

    writer = (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint_dir)
        .foreachBatch(emit)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_alerts(spark: SparkSession, sink_dir: str) -> DataFrame:
    """One row per (zone, window): the highest count reported for it."""
    stored = spark.read.schema(
        "pickup_location_id bigint, window_start timestamp_ntz, window_end timestamp_ntz, "
        "trip_count bigint, batch_id bigint"
    ).parquet(sink_dir)
    return stored.groupBy("pickup_location_id", "window_start", "window_end").agg(
        F.max("trip_count").alias("trip_count")
    )


def run_alert_stream(
    spark: SparkSession, history: DataFrame, source_dir: str, file_glob: str = "*.parquet", q: float = ALERT_QUANTILE
) -> DataFrame:
    """Bounded run: threshold from ``history``, stream ``source_dir`` to
    completion, return the de-duplicated alerts."""
    threshold = window_threshold(history, q).first()["threshold"]
    sink = scratch_dir(spark, "alerts-sink")
    ckpt = scratch_dir(spark, "alerts-ckpt")
    if threshold is None:
        return spark.createDataFrame([], ALERT_SCHEMA)
    query = start_alert_stream(spark, source_dir, int(threshold), sink, ckpt, file_glob)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    try:
        return read_alerts(spark, sink)
    except AnalysisException:  # nothing alerted: the sink folder holds no files
        return spark.createDataFrame([], ALERT_SCHEMA)


def main(argv=None) -> None:
    """Run the alert stream as a job::

        python -m zonepulse.streaming.alerts --history /data/events --source /landing/events \\
            --sink /shared/alerts --checkpoint /shared/alerts-ckpt [--once]
    """
    import argparse

    from zonepulse.session import build_session

    parser = argparse.ArgumentParser(description="zonepulse demand-alert stream")
    parser.add_argument("--history", required=True, help="Parquet events used for the threshold")
    parser.add_argument("--source", required=True, help="folder where new Parquet event files arrive")
    parser.add_argument("--sink", required=True)
    parser.add_argument("--checkpoint", required=True, help="stream checkpoint (shared storage)")
    parser.add_argument("--quantile", type=float, default=ALERT_QUANTILE)
    parser.add_argument("--max-files-per-trigger", type=int, default=None)
    parser.add_argument("--once", action="store_true", help="process what is there, then stop")
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)
    spark = build_session(args.master, app_name="zonepulse-alerts")
    threshold = window_threshold(spark.read.parquet(args.history), args.quantile).first()["threshold"]
    if threshold is None:
        raise SystemExit("empty history: no threshold")
    query = start_alert_stream(
        spark,
        args.source,
        int(threshold),
        args.sink,
        args.checkpoint,
        available_now=args.once,
        max_files_per_trigger=args.max_files_per_trigger,
    )
    query.awaitTermination()


if __name__ == "__main__":
    main()
