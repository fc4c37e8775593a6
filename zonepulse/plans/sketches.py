"""Mergeable sketches by day (T1/T2 approximate thresholds, G7/R2 distincts).

The store holds one row per calendar day (or month: ``unit``) with a KLL
sketch of each measure and an HLL sketch of each key column, some kilobytes
each whatever the day's trips. A delivery of whole units replaces their rows
only (dynamic partition overwrite), and a threshold or a distinct count of any
span of days is the merge of its rows: no trip is read again.

Bounds: the rank of a KLL quantile is off by at most ``rank_error(k)`` of all
values with 99 % confidence (0.35 % at the default, inside the 1 % that the
approximate zone threshold asks); an HLL estimate by ``3 * 1.04 / sqrt(2 ** lg_k)``,
three standard errors. A unit without a valid trip leaves a row of NULL
sketches; NULL and NaN values take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.operators.clean import clean_trips
from zonepulse.plans.refresh import DAY

KLL_K = 800
HLL_LG_K = 12
MEASURES = ("trip_distance", "trip_duration_min", "fare_amount")
KEYS = ("pickup_location_id", "dropoff_location_id")


def rank_error(k: int = KLL_K) -> float:
    """Published bound of a KLL sketch's normalised rank error (99 %)."""
    return 2.296 / k**0.9723


def distinct_error(lg_k: int = HLL_LG_K) -> float:
    return 3 * 1.04 / 2 ** (lg_k / 2)


def _value(column: str) -> Column:
    number = F.col(column).cast("double")
    return F.when(~F.isnan(number), number)


def _hashed(column: str) -> Column:
    """Any type as the long that HLL takes; NULL stays NULL."""
    return F.when(F.col(column).isNotNull(), F.xxhash64(column))


def unit_sketches(
    silver: DataFrame,
    unit: Sequence[str] = DAY,
    measures: Sequence[str] = MEASURES,
    keys: Sequence[str] = KEYS,
    k: int = KLL_K,
    lg_k: int = HLL_LG_K,
) -> DataFrame:
    """One row per unit: kll_<measure>, hll_<key>. Partial sketches are merged
    map-side, so a unit with a third of all trips ships one row per task."""
    return silver.groupBy(*unit).agg(
        *[F.kll_sketch_agg_double(_value(c), k).alias(f"kll_{c}") for c in measures],
        *[F.hll_sketch_agg(_hashed(c), lg_k).alias(f"hll_{c}") for c in keys],
    )


def refresh_sketches(delivered: DataFrame, store: str, unit: Sequence[str] = DAY, **sketched) -> DataFrame:
    """Clean the raw trips of the delivered units (each whole) and put their
    sketches in place of the stored ones. Returns the store."""
    fresh = unit_sketches(clean_trips(delivered), unit, **sketched)
    units = delivered.select(*[F.col(c).alias(f"_{c}") for c in unit]).distinct()
    same = reduce(and_, [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in unit])
    rows = units.join(fresh, same, "left").select(
        *[F.col(f"_{c}").alias(c) for c in unit], *[c for c in fresh.columns if c not in unit]
    )
    writer = rows.repartition(*unit).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*unit).parquet(store)
    return delivered.sparkSession.read.schema(rows.schema).parquet(store)


def merged_quantiles(sketches: DataFrame, measure: str, quantiles: Sequence[float]) -> DataFrame:
    """(measure, quantile, value, n) from the merge of the given rows; value is
    NULL where they hold none."""
    merged = sketches.where(F.col(f"kll_{measure}").isNotNull()).agg(F.kll_merge_agg_double(f"kll_{measure}").alias("s"))
    n = F.coalesce(F.kll_sketch_get_n_double("s"), F.lit(0))

    def answer(q: float) -> Column:  # the rank must be a literal
        value = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(q)))
        return F.struct(F.lit(q).alias("quantile"), value.alias("value"))

    answers = F.explode(F.array(*[answer(float(q)) for q in quantiles])).alias("a")
    return merged.select("s", n.alias("n")).select("n", answers).select(F.lit(measure).alias("measure"), "a.*", "n")


def merged_distinct(sketches: DataFrame, key: str) -> DataFrame:
    """(key, distinct_values) estimated from the merge of the given rows."""
    found = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"hll_{key}")), F.lit(0))
    return sketches.agg(found.alias("distinct_values")).select(F.lit(key).alias("key"), "distinct_values")


def measured_quantiles(
    sketches: DataFrame, silver: DataFrame, measures: Sequence[str], quantiles: Sequence[float], bound: float
) -> DataFrame:
    """The merged quantiles held against exact ranks over all trips:
    (measure, quantile, n, within_bound). One scan for all of them."""
    asked = reduce(DataFrame.unionByName, [merged_quantiles(sketches, c, quantiles) for c in measures])
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), _value(c).alias("x")) for c in measures]))
    met = silver.select(values.alias("v")).select("v.*").where("x IS NOT NULL").join(F.broadcast(asked), "measure")
    below, upto = F.count_if(F.col("x") < F.col("value")), F.count_if(F.col("x") <= F.col("value"))
    n = F.count(F.lit(1))
    q = F.col("quantile")
    return met.groupBy("measure", "quantile").agg(
        n.alias("n"),
        ((F.first("n") == n) & (below / n - bound <= F.first(q)) & (upto / n + bound >= F.first(q))).alias("within_bound"),
    )
