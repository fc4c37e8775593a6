"""Exact deduplication with two-pass Bloom filtering, DataFrame operations only.

Texts are equal when they are identical after each run of white space became
one space. Pass 1 spreads 64-bit hashes of all texts over a bit space of some
64 bits per row, kept as (word, mask, rows) and combined on the map side: a
word that got more rows than it has bits set holds a repeated bit. Pass 2
folds those words into a filter of fixed size, broadcasts it and marks every
row whose hash is possibly repeated. What pass 1 shuffles is a word, a mask and
a count for nearly every row, never a text or an id; in pass 2 only marked rows
shuffle and the rest pass straight through. A filter that fills up marks more rows and changes no result.

Defined cases: a null text counts as empty, and all empty texts are one
group. A null id never wins over a number; a group of null ids only has a null
keep_id. Of rows that repeat both id and text, exactly one is kept. Columns
beside the id and the text pass through ``dedup`` untouched, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import FILTER_BITS, attach_groups, member_filter, normalised, probe, stored

#: Bits of the first filter for each row, as a power of two.
FIRST_BITS_PER_ROW = 64


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, sha (32 bytes), h (64 bits), row (all columns of ``docs``)."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.sha2(normalised(text_col).cast("binary"), 256)).alias("sha"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    ).withColumn("h", F.xxhash64("sha"))


def _first_word(rows: int):
    """The word of the first filter that a row's hash falls into."""
    words = 1 << max(10, (rows * FIRST_BITS_PER_ROW // 64).bit_length())
    return F.shiftrightunsigned(F.col("h"), 6).bitwiseAND(F.lit(words - 1).cast("long"))


def repeated_filter(keys: DataFrame, rows: int, bits: int = FILTER_BITS) -> DataFrame:
    """Pass 1 and its fold into the fixed-size filter that pass 2 broadcasts."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("h").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    words = keys.groupBy(_first_word(rows).alias("word")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_or(bit).alias("bits")
    )
    suspects = words.where(F.col("n") > F.bit_count("bits")).select(F.xxhash64("word").alias("w"))
    return member_filter(suspects, "w", bits)


def _marked(hashed: DataFrame, rows: int, members: DataFrame, bits: int) -> DataFrame:
    return probe(hashed.withColumn("w", F.xxhash64(_first_word(rows))), "w", members, "maybe", bits).drop("w")


def _groups(docs: DataFrame, id_col: str, text_col: str, bits: int):
    """(keys, by_id, groups, members, rows): ``by_id`` has a row for each (sha,
    doc_id) among the marked rows, ``groups`` one for each sha among them."""
    keys = stored(_hashed(docs, id_col, text_col).select("doc_id", "sha", "h"), "dedup-keys")
    rows = keys.count()
    members = stored(repeated_filter(keys, rows, bits), "dedup-filter")
    marked = _marked(keys, rows, members, bits)
    by_id = stored(
        marked.where("maybe").groupBy("sha", "doc_id").agg(F.count(F.lit(1)).alias("same")), "dedup-marked"
    )
    groups = stored(
        by_id.groupBy("sha").agg(
            F.min("doc_id").alias("keep_id"), F.sum("same").alias("group_size"), F.count(F.lit(1)).alias("ids")
        ),
        "dedup-groups",
    )
    return marked, by_id, groups, members, rows


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    marked, by_id, groups, _, _ = _groups(docs, id_col, text_col, bits)
    straight = marked.where(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "sha",
    )
    met = attach_groups(by_id, groups, ["sha"], "ids").select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("same"))).alias("nth")
    )
    met = met.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "sha",
    )
    return straight.unionByName(met).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` without the repeats: whole rows, of each group the one with the
    smallest id. Rows that the filter clears never leave their task."""
    _, _, groups, members, rows = _groups(docs, id_col, text_col, bits)
    marked = _marked(_hashed(docs, id_col, text_col), rows, members, bits)
    straight = marked.where(~F.col("maybe")).select("row.*")
    one = marked.where("maybe").groupBy("sha", "doc_id").agg(F.first("row").alias("row"))
    keep = groups.select(F.col("sha").alias("k_sha"), "keep_id")
    kept = one.join(
        keep, (one.sha == keep.k_sha) & one.doc_id.eqNullSafe(keep.keep_id), "left_semi"
    ).select("row.*")
    return straight.unionByName(kept)
