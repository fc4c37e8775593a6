"""Adapters from the shipped test tables onto the canonical trip schema.

Canonical raw trips::

    trip_id bigint, trip_distance double, trip_duration bigint (seconds),
    pickup_location_id bigint, dropoff_location_id bigint,
    year int, month int, day int, day_of_week int (0 = Mon), hour_of_day int,
    fare_amount double, tip_amount double, total_amount double

Canonical zone dimension: ``zone_id bigint, zone_name string, borough string``
with ``zone_id`` unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.functions.calendar import epoch_seconds, time_parts
from zonepulse.operators.zones import unique_zones
from zonepulse.plans.joins import dimension_join
from zonepulse.session import materialize

ROWS_PER_RANGE_PARTITION = 5_000_000

RAW_COLUMNS = [
    "trip_id",
    "trip_distance",
    "trip_duration",
    "pickup_location_id",
    "dropoff_location_id",
    "year",
    "month",
    "day",
    "day_of_week",
    "hour_of_day",
    "fare_amount",
    "tip_amount",
    "total_amount",
]


def _time_columns(ts) -> list:
    return [c.cast("int").alias(name) for name, c in time_parts(ts).items()]


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Fixture B: one trip per line item; a pure projection (no shuffle),
    so filters on the source columns reach the Parquet scan."""
    li = F.col
    price = li("l_extendedprice") / F.lit(1000)
    duration = (
        F.lit(30)
        + (li("l_orderkey") * 37 + li("l_partkey") * 11 + li("l_linenumber") * 101) % F.lit(15000)
    ).cast("bigint")
    hour = ((li("l_orderkey") + li("l_linenumber")) % F.lit(24)).cast("int")
    parts = time_parts("l_shipdate")
    return lineitem.select(
        li("l_orderkey").cast("bigint").alias("trip_id"),
        li("l_quantity").cast("double").alias("trip_distance"),
        duration.alias("trip_duration"),
        li("l_suppkey").cast("bigint").alias("pickup_location_id"),
        li("l_partkey").cast("bigint").alias("dropoff_location_id"),
        parts["year"].cast("int").alias("year"),
        parts["month"].cast("int").alias("month"),
        parts["day"].cast("int").alias("day"),
        parts["day_of_week"].cast("int").alias("day_of_week"),
        hour.alias("hour_of_day"),
        price.alias("fare_amount"),
        (price * li("l_discount")).alias("tip_amount"),
        (price * (F.lit(1) + li("l_discount") + li("l_tax"))).alias("total_amount"),
    )


def next_event_time(
    events: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    tiebreak: str = "event_id",
    partitions: int | None = None,
    out: str = "next_ts",
) -> DataFrame:
    """Add the timestamp of the same key's next event (ordered by ``ts``,
    then ``tiebreak``); NULL for the key's last event.

    Equivalent to ``lead(ts) OVER (PARTITION BY key ORDER BY ts, tiebreak)``,
    which would send every event of a hot key (a third of all rows, say)
    through one task. Here the rows are range-partitioned on
    (key, ts, tiebreak) — Spark samples the bounds, so a hot key, or a hot
    key on one busy day, is cut into many balanced partitions — and
    ``lead`` runs inside each range partition. The last row of a partition
    takes the first row of the next non-empty partition, looked up in a
    frame with one row per partition (bounded by ``partitions``, hence
    broadcast). The range-partitioned rows are stored once so that every
    step sees the same partition ids.
    """
    spark = events.sparkSession
    # about ROWS_PER_RANGE_PARTITION events per partition (a Parquet row
    # count is answered from file metadata), never fewer than the session's
    # shuffle partitions
    n = partitions or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        -(-events.count() // ROWS_PER_RANGE_PARTITION),
    )
    order = [F.col(key), F.col(ts), F.col(tiebreak)]
    # Range bounds come from sampling seeded by the RDD id, so two separate
    # range exchanges may cut differently: the partition ids are fixed once
    # by storing the range-partitioned rows (shared checkpoint folder), and
    # every later step reads that copy.
    ranged = materialize(
        events.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()), "events-by-range"
    )
    # One exchange brings each stored partition together again, in as many
    # tasks as there are partitions; the window below needs no other.
    in_part = Window.partitionBy("_pid").orderBy(*order)
    staged = ranged.repartition(n, "_pid").select(
        "*",
        F.lead(key).over(in_part).alias("_lead_key"),
        F.lead(ts).over(in_part).alias("_lead_ts"),
        F.lead(F.lit(1)).over(in_part).isNull().alias("_is_last"),
    )
    # The first row of every non-empty partition (a map-side minimum), then
    # the next partition's first row for each partition: at most ``n`` rows.
    firsts = ranged.groupBy("_pid").agg(F.min(F.struct(key, ts, tiebreak)).alias("_f"))
    across = Window.orderBy("_pid")  # one row per partition: bounded by n
    handoff = firsts.select(
        "_pid",
        F.lead(F.col("_f")[key]).over(across).alias("_next_key"),
        F.lead(F.col("_f")[ts]).over(across).alias("_next_ts"),
    )
    joined = staged.join(F.broadcast(handoff), "_pid", "left")
    same_as_lead = F.col("_lead_key").eqNullSafe(F.col(key))
    same_as_next = F.col("_next_key").eqNullSafe(F.col(key))
    last_in_part = F.col("_is_last")
    nxt = (
        F.when(~last_in_part & same_as_lead, F.col("_lead_ts"))
        .when(last_in_part & same_as_next, F.col("_next_ts"))
    )
    return joined.withColumn(out, nxt).drop("_pid", "_lead_key", "_lead_ts", "_is_last", "_next_key", "_next_ts")


def trips_from_events(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fixture A: an event is a pickup in zone ``user_id``; the trip lasts
    until the same user's next event (difference of whole epoch seconds,
    independent of the session time zone).
    The dropoff zone is the integer ``k`` of the JSON ``props``."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    # only the columns the trips need: the lookup stores a copy, and column
    # pruning cannot reach through a write
    used = events.select("event_id", "ts", "user_id", "value", "props")
    with_next = next_event_time(used, partitions=partitions)
    ts_type = dict(events.dtypes)["ts"]
    start = epoch_seconds("ts", ts_type)
    end = epoch_seconds("next_ts", ts_type)
    return with_next.select(
        F.col("event_id").cast("bigint").alias("trip_id"),
        F.col("value").cast("double").alias("trip_distance"),
        (end - start).cast("bigint").alias("trip_duration"),
        F.col("user_id").cast("bigint").alias("pickup_location_id"),
        k.alias("dropoff_location_id"),
        *_time_columns("ts"),
        F.col("value").cast("double").alias("fare_amount"),
        (k / F.lit(10)).alias("tip_amount"),
        (F.col("value") + k / F.lit(10)).alias("total_amount"),
    )


def zone_rows_from_suppliers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Zone dimension for both fixtures: supplier -> zone, nation -> borough.

    The nation side goes through the checked dimension join (broadcast
    after its size is verified). Ids may repeat: see ``unique_zones``.
    """
    s = supplier.select(
        F.col("s_suppkey").cast("bigint").alias("zone_id"),
        F.col("s_name").alias("zone_name"),
        F.col("s_nationkey").alias("_nk"),
    )
    n = nation.select(F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("borough"))
    return dimension_join(s, n, "_nk", "_nk", "left").drop("_nk")


def zones_from_suppliers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return unique_zones(zone_rows_from_suppliers(supplier, nation))
