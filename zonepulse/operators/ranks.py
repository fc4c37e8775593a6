"""R5 over trips: Spearman rank correlation with ranks worked out in parts.

A rank needs the whole order of a column, but no task has to see it. The
distinct values of a column are counted (combined map-side, so a value that
fills a third of all trips is one row) and range-partitioned; each partition
sums its counts in order, and its offset is the sum of the partitions before
it. Equal values share their mean rank. Ranks meet the trips by
``dimension_join``: broadcast if measured small, else salted by hot value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.operators.profile import feature_correlation
from zonepulse.plans.joins import BROADCAST_MAX_ROWS, dimension_join
from zonepulse.session import materialize


def mean_ranks(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """(``column``, mean_rank) for every distinct value: ranks from 1, equal
    values share the mean of theirs; NULLs have none, NaN is the greatest.

    The range-partitioned counts are stored, since range bounds are sampled
    anew by each exchange. The driver sees one sum for each partition."""
    spark = df.sparkSession
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = materialize(
        counts.repartitionByRange(parts, column).withColumn("_part", F.spark_partition_id()), "rank-counts"
    )
    sums = ordered.groupBy("_part").agg(F.sum("_n").alias("_sum")).orderBy("_part").collect()  # one row a partition
    before = [0, *accumulate(r["_sum"] for r in sums)]
    offsets = spark.createDataFrame([(r["_part"], b) for r, b in zip(sums, before)], "_part int, _before bigint")
    upto = F.sum("_n").over(Window.partitionBy("_part").orderBy(column))
    # Mean of the ranks before + 1 .. before + n of a value.
    rank = F.col("_before") + upto - (F.col("_n") - 1) / F.lit(2.0)
    return ordered.join(F.broadcast(offsets), "_part").select(column, rank.alias("mean_rank"))


def rank_correlation(
    df: DataFrame, columns: Sequence[str], partitions: int | None = None, max_rows: int = BROADCAST_MAX_ROWS
) -> DataFrame:
    """Spearman's rho of every pair of ``columns``, one row per pair, over the
    rows where all of them have a value (no NULL, no NaN). A column of one
    value only, or no row at all, gives NULL."""
    whole = [F.col(c).isNotNull() for c in columns]
    whole += [~F.isnan(c) for c in columns if dict(df.dtypes)[c] in ("double", "float")]
    cases = materialize(df.where(reduce(and_, whole)).select(*columns), "rank-cases")
    ranked = cases
    for c in columns:
        ranks = mean_ranks(cases, c, partitions).withColumnRenamed("mean_rank", f"_rank_{c}")
        ranked = dimension_join(ranked, materialize(ranks, "ranks"), c, how="inner", max_rows=max_rows)
    return feature_correlation(ranked.select(*[F.col(f"_rank_{c}").alias(c) for c in columns]), columns)
