"""Mixing sources to target weights by systematic sampling.

Sources share a budget by weight; none may take more than ``cap`` times its
size, and the excess goes to the others by weight until none is above (water
filling). Within a source every document expects target / size copies. With
the documents in order of size, one prefix sum of expected copies and one
random offset per source, a document is emitted once for each integer
boundary that its share of the prefix sum crosses. Ordering by size keeps the
taken words within one document's size of the target.

The prefix sum is distributed: rows are range partitioned by (source, size,
hash of the id), numbered inside their partition, and a small table of counts
per (source, partition) carries the offsets, so a hot source spreads over many
tasks. Order and offsets come from MD5 digests, so reruns agree.

Size is the number of words. Defined cases: a null text has size 0 (expects
copies, takes no words); a null source is a source of its own, last in order;
null ids are ordered last among equals; rows equal in id and size get copies
that differ by which of them came first, so the result as a whole agrees; a
table without words takes nothing; an empty table gives an empty result. Other
columns pass through ``mix`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonepulse.llm.common import WORDS, stored, text_of

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2


def words(text_col: str = "text") -> Column:
    return F.regexp_count(text_of(text_col), F.lit(WORDS)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """source, source_size -> also target. One row per source: the sources that
    reach their cap are the first in order of size / weight, so the level of
    the others follows from prefix sums over that order."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    every = W.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before = every.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    lists = F.array(*[F.lit(x) for x in weights])
    frame = sizes.withColumn("weight", F.element_at(lists, (F.pmod(place, F.lit(len(weights))) + 1).cast("int")))
    level = (
        F.lit(budget) * F.sum("source_size").over(whole) - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    frame = frame.withColumn("level", level)
    full = F.col("level") * F.col("weight") >= F.lit(cap) * F.col("source_size")
    frame = frame.withColumn("full", full)
    # The first source that stays below its cap fixes the level of all after
    # it; levels worked out as if it were full are lower.
    final = F.max(F.when(~F.col("full"), F.col("level"))).over(whole)
    return frame.withColumn("final", final).select(
        "source",
        "source_size",
        F.when(F.col("full"), (F.lit(cap) * F.col("source_size")).cast("double"))
        .otherwise(F.col("final") * F.col("weight"))
        .cast("double")
        .alias("target"),
    )


def _fraction(text: Column) -> Column:
    """A number in [0, 1) from a digest."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _row_key(columns: list[str], text_col: str) -> Column:
    """128 bits of the whole row, never null."""
    parts = [
        F.md5(F.col(f"`{c}`").cast("string").cast("binary")) if c == text_col else F.col(f"`{c}`") for c in columns
    ]
    return F.unhex(F.md5(F.to_json(F.struct(*[p.alias(f"c{k}") for k, p in enumerate(parts)])).cast("binary")))


def with_copies(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 0,
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    cap: int = CAP,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and row_key for every
    row. No text leaves its task."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        words(text_col).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("~")).cast("binary")).alias("h"),
        _row_key(docs.columns, text_col).alias("row_key"),
        # Equal rows are cut between ranges by a number of their own.
        F.rand(seed).alias("spread"),
    )
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("h"), F.col("row_key"), F.col("spread")]
    rows = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()),
        "mix-ordered",
    ).withColumn("part", F.shiftright("place", 33))
    counts = stored(
        rows.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"), F.sum("size").alias("words")),
        "mix-counts",
    )
    before = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("source", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    plan = targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, budget, cap)
    plan = offsets.withColumnRenamed("source", "s").join(plan, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    plan = plan.withColumnsRenamed({"source": "p_source", "part": "p_part"})
    met = rows.join(plan, (rows.part == F.col("p_part")) & rows.source.eqNullSafe(F.col("p_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))
    nth = (F.col("before") + F.col("place") - F.col("first")).cast("double")
    offset = _fraction(key)
    copies = F.floor((nth + 1) * rate + offset) - F.floor(nth * rate + offset)
    return met.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.least(copies, F.lit(cap)).cast("long").alias("copies"),
        "row_key",
    )


def taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted)."""
    return with_copies(docs, **options).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mixture itself: whole rows, repeated as often as they are emitted.
    Texts shuffle once, by a hash of the whole row; rows equal in all columns
    are one row with the sum of their copies, folded where they are read."""
    copies = with_copies(docs, source_col=source_col, id_col=id_col, text_col=text_col, **options)
    copies = copies.groupBy("row_key").agg(F.sum("copies").alias("copies")).where("copies > 0")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _row_key(docs.columns, text_col).alias("row_key"))
    return (
        rows.groupBy("row_key")
        .agg(F.first("row").alias("row"))
        .join(copies, "row_key")
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth"))
        .select("row.*")
    )
