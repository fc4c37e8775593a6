"""Sharding by fixed virtual slots, DataFrame operations only.

Every record hashes into one of ``SLOTS`` virtual slots for good. Only the
slots are placed: bytes are summed per slot, and a versioned map slot -> shard
is stored. Rebalancing writes a new version in which some slots moved; no
record is hashed again. The map and the slot sizes hold ``SLOTS`` rows
whatever the input, so the driver may edit them and a join may broadcast them.

Sizes are UTF-8 bytes of the text plus 16. Defined cases: a null text has
size 16 and checksum 0; null ids hash by their text; rows equal in id and text
are numbered and spread over slots by their number, which of them has which
number is open; an empty table gives an empty result and a map of untouched
slots. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonepulse.llm.common import stored, text_of
from zonepulse.session import scratch_dir

SLOTS = 16_384
RECORD_BYTES = 16
#: Rebalancing stops when the fullest and the emptiest shard differ by less
#: than this part of a mean shard, or no single move helps.
TOLERANCE = 0.0005


def in_slots(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot for every row."""
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(id_col).cast("long"), F.xxhash64(text)).alias("h"),
        F.spark_partition_id().alias("task"),
    )
    # Repeats are numbered within the task that read them, after those of the
    # tasks before: a window holds one task's repeats, or one row per task.
    rows = stored(rows, "slot-hashes")
    earlier = F.sum("n").over(W.partitionBy("h").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    begins = rows.groupBy("h", "task").agg(F.count(F.lit(1)).alias("n")).select("h", "task", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    nth = F.col("earlier") + F.row_number().over(W.partitionBy("h", "task").orderBy("doc_id", "text_crc32", "size")) - 1
    slot = F.when(F.col("nth") == 0, F.col("h")).otherwise(F.xxhash64("h", "nth"))
    return (
        rows.join(begins, ["h", "task"])
        .withColumn("nth", nth)
        .select("doc_id", "size", "text_crc32", F.pmod(slot, F.lit(slots)).cast("int").alias("virtual_slot"))
    )


def slot_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def even_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0: slots dealt in turn; entry i is the shard of slot i."""
    return [i % shards for i in range(slots)]


def rebalanced(shard_of: list[int], sizes: dict[int, int], shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """The map after moving slots, each time from the fullest shard to the
    emptiest, the slot that comes nearest to halving their difference. A shard
    that no move relieves is set aside, and the next fullest is looked at. Every
    move lowers the sum of squares, so it ends. New shards start empty and
    are filled; nothing else moves between old ones than balance asks for."""
    new = list(shard_of)
    load = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, size in sizes.items():
        if size > 0:
            load[new[slot]] += size
            insort(held[new[slot]], (size, slot))
    least = tolerance * sum(load) / shards
    open_shards = list(range(shards))
    while True:
        full, empty = max(open_shards, key=load.__getitem__), min(open_shards, key=load.__getitem__)
        gap = load[full] - load[empty]
        at = bisect_left(held[full], (gap / 2, -1))
        near = [x for x in held[full][max(0, at - 1) : at + 1] if x[0] < gap]
        if gap <= least:
            return new
        if not near:
            # The least load never falls, so no later move helps it either.
            open_shards.remove(full)
            continue
        size, slot = min(near, key=lambda x: abs(x[0] - gap / 2))
        held[full].remove((size, slot))
        insort(held[empty], (size, slot))
        load[full] -= size
        load[empty] += size
        new[slot] = empty


def save_map(spark: SparkSession, folder: str, version: int, shard_of: list[int]) -> None:
    """One version of the map as a Parquet folder (slot, shard)."""
    listed = F.split(F.lit(",".join(map(str, shard_of))), ",")
    spark.range(1).select(F.posexplode(listed).alias("slot", "shard")).select(
        "slot", F.col("shard").cast("int").alias("shard")
    ).write.mode("overwrite").parquet(f"{folder}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The newest version of the map, or the given one."""
    maps = spark.read.parquet(folder)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version).drop("version")


def newest_map(spark: SparkSession, folder: str) -> tuple[int, list[int] | None]:
    """The newest version and its map (one entry a slot); None without one."""
    try:
        version = spark.read.parquet(folder).agg(F.max("version")).first()[0]
    except AnalysisException:  # an empty or missing folder
        return -1, None
    return version, [r["shard"] for r in load_map(spark, folder, version).orderBy("slot").collect()]


def shard(docs: DataFrame, shards: int, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """Every row in a shard, sizes near equal (law ``bytes``): doc_id, size,
    text_crc32, law, shard, slot (its place in the shard, from 0 without
    gaps), grown_shard (null: the sizes decide, not the id), virtual_slot,
    map_version. The map's versions stay in ``folder``: its newest version is
    edited for the new sizes and number of shards, saved as the next version,
    and that one places the rows; an empty folder starts from ``even_map``."""
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "slot-map")
    rows = stored(in_slots(docs, slots), "slot-rows")
    sizes = stored(slot_sizes(rows).coalesce(1), "slot-sizes")
    version, known = newest_map(spark, folder)
    if known is None:
        version, known = 0, even_map(shards, slots)
        save_map(spark, folder, version, known)
    if len(known) != slots:
        raise ValueError(f"the stored map has {len(known)} slots, not {slots}; their number is fixed")
    # Shards that no longer exist hand their slots on in turn.
    known = [s if s < shards else i % shards for i, s in enumerate(known)]
    version += 1
    held = {r["virtual_slot"]: r["bytes"] for r in sizes.select("virtual_slot", "bytes").collect()}
    save_map(spark, folder, version, rebalanced(known, held, shards))
    before = F.sum("rows").over(W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1))
    places = (
        load_map(spark, folder, version)
        .withColumnRenamed("slot", "virtual_slot")
        .join(sizes, "virtual_slot")
        .select("virtual_slot", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    )
    nth = F.row_number().over(W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return rows.join(F.broadcast(places), "virtual_slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + nth - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.lit(version).alias("map_version"),
    )
