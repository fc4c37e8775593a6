"""Inspection and profiling (I1-I3, R2, R3, R5): every profile aggregates in
Spark and returns a small frame, never a collect of rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, NumericType

from zonepulse.session import materialize

# Quantiles reported by the distribution summary.
SUMMARY_QUANTILES = (0.25, 0.5, 0.75, 0.9)
# Distinct values that one task of the summary may sort, and bins of a round.
VALUES_PER_TASK = 65_536
BINS = 4096


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows by an explicit key (top-k, deterministic)."""
    keys = list(order_by) if order_by else df.columns
    return df.orderBy(*keys).limit(n)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Cardinality as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def schema_profile(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``column, position, data_type, nullable`` (metadata only)."""
    rows = [(f.name, i, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "column string, position int, data_type string, nullable boolean")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def data_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """R2: per numeric column: type, rows, NULLs, NaNs, min, max, mean,
    sample stddev — all columns in ONE scan (one aggregate row, exploded
    to one row per column)."""
    cols = list(columns) if columns else numeric_columns(df)
    types = dict(df.dtypes)

    def stats(c: str):
        x = F.col(c)
        is_float = types[c] in ("double", "float")
        nan = F.count_if(F.isnan(x)) if is_float else F.lit(0).cast("bigint")
        return F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("data_type"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(x.isNull()).alias("nulls"),
            nan.alias("nans"),
            F.min(x).cast("double").alias("min"),
            F.max(x).cast("double").alias("max"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("stddev"),
        )

    return df.agg(F.array(*[stats(c) for c in cols]).alias("_p")).select(F.inline("_p"))


def _common_type(df: DataFrame, columns: Sequence[str]) -> str:
    """The type that holds the columns' values: bigint or decimal where all
    are whole or decimal (their values stay exact), else double."""
    kinds = [df.schema[c].dataType for c in columns]
    if all(isinstance(k, IntegralType) for k in kinds):
        return "bigint"
    if all(isinstance(k, (IntegralType, DecimalType)) for k in kinds):
        scale = max((k.scale for k in kinds if isinstance(k, DecimalType)), default=0)
        whole = max(k.precision - k.scale if isinstance(k, DecimalType) else 19 for k in kinds)
        return f"decimal({min(38, whole + scale)},{scale})"
    return "double"


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """A bin number that never falls as the value grows, which is all that
    ranks need; infinities and NaN stand in bins of their own."""
    x, low, high = (c.cast("double") * F.lit(0.5) for c in (value, lo, hi))  # halves: no overflow
    share = F.coalesce(F.try_divide(x - low, high - low), F.lit(0.0))
    inside = F.least(F.floor(share * F.lit(float(bins))), F.lit(bins - 1))
    inf = F.lit(float("inf"))
    return F.when(F.isnan(x), bins + 1).when(x == inf, bins).when(x == -inf, -1).otherwise(inside)


def _finite(value: Column) -> Column:
    x = value.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), value)


def _narrowed(counts: DataFrame, asked: DataFrame, bins: int) -> DataFrame:
    """One round: ``asked`` (column, quantile, rank, before, first, last, lo,
    hi, distinct) with the range of values that holds each rank cut down to
    one bin of it."""
    inside = (F.col("value") >= F.col("first")) & (F.col("value") <= F.col("last"))
    met = counts.join(F.broadcast(asked.drop("distinct")), "column").where(inside)
    of_bin = met.withColumn("bin", _bin(F.col("value"), F.col("lo"), F.col("hi"), bins)).groupBy(
        "column", "quantile", "rank", "before", "bin"
    )
    found = of_bin.agg(
        F.sum("n").alias("n"),
        F.min("value").alias("first"),
        F.max("value").alias("last"),
        F.min(_finite(F.col("value"))).alias("lo"),
        F.max(_finite(F.col("value"))).alias("hi"),
        F.count(F.lit(1)).alias("distinct"),
    )
    # At most bins + 3 rows for each (column, quantile).
    upto = F.sum("n").over(Window.partitionBy("column", "quantile").orderBy("bin"))
    reached = found.withColumn("before", F.col("before") + upto - F.col("n")).where(
        "rank > before AND rank <= before + n"
    )
    return reached.select(*asked.columns)


def distribution_summary(
    df: DataFrame,
    columns: Sequence[str],
    quantiles: Sequence[float] = SUMMARY_QUANTILES,
    values_per_task: int = VALUES_PER_TASK,
    bins: int = BINS,
) -> DataFrame:
    """Exact discrete quantiles of each column, one row per (column,
    quantile), however many distinct values there are.

    ``percentile_disc`` would merge all distinct values in one task. Here the
    (column, value) counts are stored, and the range of values that holds a
    rank is narrowed round by round: a histogram of the range, at most ``bins``
    counts a quantile, shows the bin that holds the rank, and the bin's own
    least and greatest values are the next range. Once no range has more than
    ``values_per_task`` distinct values, only those are summed up in order, so
    no task ever sees more. The driver sees one row for each quantile asked.

    Values keep their type: bigint or decimal where all columns are whole or
    decimal, else double (ask for whole numbers beyond 2^53 apart from
    floating columns). Infinities count as values and NaN as the greatest;
    NULLs do not count; a column without values gives NULL quantiles."""
    spark = df.sparkSession
    kind = _common_type(df, columns)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]))
    counts = df.select(cells.alias("c")).select("c.*").where(F.col("value").isNotNull())
    counts = materialize(counts.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    asked = (
        counts.groupBy("column")
        .agg(
            F.sum("n").alias("total"),
            F.min("value").alias("first"),
            F.max("value").alias("last"),
            F.min(_finite(F.col("value"))).alias("lo"),
            F.max(_finite(F.col("value"))).alias("hi"),
            F.count(F.lit(1)).alias("distinct"),
        )
        .withColumn("quantile", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])))
        .withColumn("rank", F.greatest(F.lit(1), F.ceil(F.col("quantile") * F.col("total"))).cast("bigint"))
        .withColumn("before", F.lit(0).cast("bigint"))
        .select("column", "quantile", "rank", "before", "first", "last", "lo", "hi", "distinct")
    )
    schema = asked.schema
    asked = spark.createDataFrame(asked.collect(), schema)  # one row a quantile
    left = asked.agg(F.max("distinct")).first()[0] or 0
    while left > values_per_task:
        asked = spark.createDataFrame(_narrowed(counts, asked, bins).collect(), schema)
        now = asked.agg(F.max("distinct")).first()[0]
        if now >= left:  # values that differ by less than a double tells apart
            break
        left = now
    met = counts.join(F.broadcast(asked), "column").where((F.col("value") >= F.col("first")) & (F.col("value") <= F.col("last")))
    upto = F.sum("n").over(Window.partitionBy("column", "quantile").orderBy("value"))
    found = (
        met.withColumn("upto", F.col("before") + upto)
        .where("upto >= rank")
        .groupBy("column", "quantile")
        .agg(F.min("value").alias("value"))
    )
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    wanted = wanted.withColumn("quantile", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])))
    return wanted.join(F.broadcast(found), ["column", "quantile"], "left").select("column", "quantile", "value")


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """Fixed-width histogram ``bin_start, trips`` (bins of ``width``;
    NULL values are not binned)."""
    start = (F.floor(F.col(column) / F.lit(width)) * F.lit(width)).cast("double")
    return (
        df.filter(F.col(column).isNotNull() & ~F.isnan(column))
        .groupBy(start.alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy("bin_start")
    )


def _correlation(a: str, b: str) -> Column:
    """Over the rows where both have a value. NULL where one of them does not
    vary (``F.corr`` divides by zero there in ANSI mode)."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def feature_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, one scan."""
    pairs = list(combinations(columns, 2))
    exprs = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), _correlation(a, b).alias("corr"))
        for a, b in pairs
    ]
    return df.agg(F.array(*exprs).alias("_c")).select(F.inline("_c"))
