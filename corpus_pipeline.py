"""The corpus pipeline: toxicity filter, exact dedup, near-duplicate join,
source mixing and packing, each an operator of ``zonepulse.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each stage's rows as Parquet in the shared folder and hands the stored
copy to the next stage, so a lost executor costs one stage's tasks at most. The
copies that a stage made on its way go once its rows are written, and its rows
once the next stage's are; the last stage's stay until the driver ends.
All stages but the last return the columns of documents. Null texts, empty
tables, repeated rows and further columns are handled as each operator's
module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonepulse.llm import dedup, mixing, ngram_join, packing, toxicity
from zonepulse.llm.common import read
from zonepulse.session import passing_copies, remove_copy, scratch_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above their language's threshold go; the classifier
    learns from the labelled ones among ``docs`` outside the hold-out."""
    return toxicity.reject(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group connected by a Jaccard similarity of 0.8 or more over
    five-word shingles the document with the smallest id stays."""
    return ngram_join.dedup_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out until sources near their targets."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens, ids included."""
    return packing.pack(docs, added=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier, the similarity join and the tokenizer have no SQL form;
#: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        target = scratch_dir(spark, f"stage-{name}")
        with passing_copies(spark):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(target)
        if before:
            remove_copy(spark, before)
        docs, before = spark.read.parquet(target), target
    return docs
