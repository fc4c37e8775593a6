"""R1 beyond the plain alert stream: rows behind the watermark, thresholds that
change while the stream runs, and alert episodes.

*Late rows.* The alert stream drops what its watermark has passed. A second,
stateless stream over the same files keeps the ledger: the pickups of every
micro-batch by zone and window, one folder a batch, overwritten when a batch is
replayed. A window's sum over the ledger less what the alert stream counted is
its number of late rows; ``reconciled`` puts them back.

*Thresholds* are stored with a version. The alert stream given a folder in
place of a number reads the newest version anew in each micro-batch.

*Episodes* are runs of consecutive alerting windows of one zone, found by
``session_window`` over the stored alerts, in batch or as a stream whose state
ends with the watermark.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonepulse.functions.calendar import instant_from_ntz, ntz_from_instant
from zonepulse.streaming import alerts as A

LEDGER_SCHEMA = f"{A.ALERT_SCHEMA}, batch_id bigint"
EPISODE_SCHEMA = "pickup_location_id bigint, episode_start timestamp_ntz, episode_end timestamp_ntz, hours bigint, peak bigint"
#: One clock hour joins the next if the gap is a little more than an hour.
EPISODE_GAP = "61 minutes"


# --- late rows -----------------------------------------------------------


def start_ledger_stream(
    spark: SparkSession,
    source_dir: str,
    ledger_dir: str,
    checkpoint_dir: str,
    file_glob: str = "*.parquet",
    window: str = A.WINDOW,
    max_files_per_trigger: int | None = None,
    schema: str = A.EVENT_SCHEMA,
) -> StreamingQuery:
    """Count every pickup of the source by zone and window, late or not. No
    state: each micro-batch writes its own partial counts, so a batch that is
    replayed writes the same folder again."""
    spark = spark.newSession()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def emit(batch: DataFrame, batch_id: int) -> None:
        counts = A._present(A.window_counts(batch, window))
        counts.write.mode("overwrite").parquet(f"{ledger_dir}/batch_id={batch_id}")

    return (
        A.pickups(reader.parquet(source_dir))
        .writeStream.option("checkpointLocation", checkpoint_dir)
        .foreachBatch(emit)
        .trigger(availableNow=True)
        .start()
    )


def _stored(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException:  # nothing was written
        return spark.createDataFrame([], schema)


def window_totals(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """All pickups by zone and window, whenever they came."""
    cells = _stored(spark, ledger_dir, LEDGER_SCHEMA)
    return cells.groupBy("pickup_location_id", "window_start", "window_end").agg(F.sum("trip_count").alias("trip_count"))


def reconciled(spark: SparkSession, ledger_dir: str, counts_dir: str) -> DataFrame:
    """pickup_location_id, window_start, window_end, trip_count (all rows),
    late_rows (those that the alert stream, whose counts of every window lie
    in ``counts_dir``, has not counted)."""
    keys = ["pickup_location_id", "window_start", "window_end"]
    counted = A.read_alerts(spark, counts_dir) if _has_files(spark, counts_dir) else spark.createDataFrame([], A.ALERT_SCHEMA)
    counted = counted.withColumnRenamed("trip_count", "counted")
    return (
        window_totals(spark, ledger_dir)
        .join(counted, keys, "left")
        .select(*keys, "trip_count", (F.col("trip_count") - F.coalesce("counted", F.lit(0))).alias("late_rows"))
    )


def _has_files(spark: SparkSession, folder: str) -> bool:
    try:
        spark.read.parquet(folder)
    except AnalysisException:
        return False
    return True


# --- thresholds ----------------------------------------------------------


def store_threshold(spark: SparkSession, folder: str, threshold: int) -> int:
    """Store a new version of the threshold; returns its number."""
    version = _newest(spark, folder)[0] + 1
    row = spark.createDataFrame([(version, int(threshold))], "version bigint, threshold bigint")
    row.coalesce(1).write.mode("append").parquet(folder)
    return version


def _newest(spark: SparkSession, folder: str) -> tuple[int, int | None]:
    rows = _stored(spark, folder, "version bigint, threshold bigint")
    row = rows.agg(F.max(F.struct("version", "threshold")).alias("v")).first()["v"]
    return (row["version"], row["threshold"]) if row else (0, None)


def newest_threshold(spark: SparkSession, folder: str) -> int | None:
    """The threshold of the newest version; None before the first."""
    return _newest(spark, folder)[1]


# --- episodes ------------------------------------------------------------


def _sessions(hours: DataFrame, gap: str) -> DataFrame:
    found = hours.groupBy(F.session_window("at", gap).alias("w"), "pickup_location_id").agg(
        F.min("at").alias("first"),
        F.max("until").alias("until"),
        F.count_distinct("at").alias("hours") if not hours.isStreaming else F.size(F.collect_set("at")).cast("bigint").alias("hours"),
        F.max("trip_count").alias("peak"),
    )
    return found.select(
        "pickup_location_id",
        ntz_from_instant("first").alias("episode_start"),
        ntz_from_instant("until").alias("episode_end"),
        "hours",
        "peak",
    )


def _hours(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "pickup_location_id",
        instant_from_ntz("window_start").alias("at"),
        instant_from_ntz("window_end").alias("until"),
        "trip_count",
    )


def alert_episodes(alerts: DataFrame, gap: str = EPISODE_GAP) -> DataFrame:
    """One row per zone and run of consecutive alerting windows: its start,
    end, number of windows and highest count. Rows that report a window again
    with another count do not count twice."""
    return _sessions(_hours(alerts), gap)


def start_episode_stream(
    spark: SparkSession,
    alerts_dir: str,
    episodes_dir: str,
    checkpoint_dir: str,
    watermark: str = "6 hours",
    gap: str = EPISODE_GAP,
    state_partitions: int = A.STATE_PARTITIONS,
) -> StreamingQuery:
    """Episodes of the stored alerts as they arrive: an episode is written
    once, when the watermark passes its gap, and its state is freed."""
    spark = spark.newSession()
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", A.STATE_STORE)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    hours = _hours(spark.readStream.schema(LEDGER_SCHEMA).parquet(alerts_dir)).withWatermark("at", watermark)
    return (
        _sessions(hours, gap)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start(episodes_dir)
    )


def read_episodes(spark: SparkSession, alerts_dir: str, episodes_dir: str) -> DataFrame:
    """The finished episodes, and those still open: sessions of the alerts
    that belong to no finished one."""
    done = _stored(spark, episodes_dir, EPISODE_SCHEMA)
    spans = done.select(F.col("pickup_location_id").alias("zone"), F.explode(F.sequence("episode_start", F.col("episode_end") - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    alerts = A.read_alerts(spark, alerts_dir)
    rest = alerts.join(spans, (alerts.pickup_location_id == spans.zone) & (alerts.window_start == spans.hour), "left_anti")
    return done.unionByName(alert_episodes(rest))
