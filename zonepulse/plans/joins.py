"""Join strategy for fact ⋈ dimension lookups.

A dimension side is broadcast only after its rows and bytes were measured
against a bound. Beyond the bound the join shuffles, and every key with more
fact rows than ``ROWS_PER_SALT`` is spread over as many salts as it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.session import materialize

# Broadcast bound for a dimension side, measured (Spark's own limit is 8 GB;
# stay far below on purpose).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
# Fact rows of one key that a join task may meet.
ROWS_PER_SALT = 5_000_000
#: Bytes of a row beside its strings and binaries: 8 a column and a header.
ROW_OVERHEAD = 32


def _variable_bytes(field: T.StructField):
    """Measured bytes of a string or binary column, else None."""
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    return None


def measured_size(dim: DataFrame) -> tuple[int, int] | None:
    """(rows, bytes) of a dimension from one aggregation; None for columns
    whose size cannot be measured that way (arrays, maps, structs)."""
    simple = (T.StringType, T.BinaryType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if not all(isinstance(f.dataType, simple) for f in dim.schema.fields):
        return None
    variable = [b for b in map(_variable_bytes, dim.schema.fields) if b is not None]
    width = sum(variable, F.lit(0)).cast("long") + F.lit(ROW_OVERHEAD + 8 * len(dim.columns))
    rows, size = dim.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows, size


def broadcast_ok(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``dim`` was measured to be small enough to broadcast."""
    size = measured_size(dim)
    return size is not None and size[0] <= max_rows and size[1] <= max_bytes


def salted_keys(fact: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(key, salts) for every non-null key with more than ``rows_per_salt``
    fact rows: about ``rows / rows_per_salt`` salts each, without a cap. At
    most ``fact rows / rows_per_salt`` rows; the count combines map-side."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > rows_per_salt).select(
        "_hot_key", F.ceil(F.col("_n") / F.lit(rows_per_salt)).cast("long").alias("_salts")
    )


def _spread(fact: DataFrame):
    """A number for each fact row that a rerun of its task repeats and that
    parts equal rows of different tasks. Columns that cannot be hashed (maps)
    are left out."""
    plain = [F.col(f"`{f.name}`") for f in fact.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*plain, F.spark_partition_id())


def dimension_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str | None = None,
    how: str = "left",
    drop_dim_key: bool = True,
    max_rows: int = BROADCAST_MAX_ROWS,
    rows_per_salt: int = ROWS_PER_SALT,
    few_rows_per_key: bool = False,
) -> DataFrame:
    """``fact`` joined to a dimension that is unique on ``dim_key``.

    * small dimension (measured): broadcast hash join, no shuffle of the fact;
    * ``few_rows_per_key``: the fact was aggregated by its key, so no key can
      be hot, and a plain shuffle join serves without a look at the fact;
    * otherwise: shuffle join on (key, salt). Keys beyond ``rows_per_salt``
      rows get several salts and only their dimension row is repeated; NULL
      keys, which match nothing, are spread over all tasks.

    The table of salted keys has at most ``fact rows / rows_per_salt`` rows
    (200,000 at 10^12), stays a frame, and is broadcast after being counted.
    """
    dim_key = dim_key or fact_key
    same_name = dim_key == fact_key
    dim_key_col = "_dim_key" if same_name else dim_key
    if same_name:
        dim = dim.withColumnRenamed(dim_key, dim_key_col)

    if broadcast_ok(dim, max_rows=max_rows):
        joined = fact.join(F.broadcast(dim), fact[fact_key] == dim[dim_key_col], how)
    elif few_rows_per_key:
        joined = fact.join(dim, fact[fact_key] == dim[dim_key_col], how)
    else:
        spark = fact.sparkSession
        hot = materialize(salted_keys(fact, fact_key, rows_per_salt), "hot-keys")
        small = F.broadcast(hot) if broadcast_ok(hot) else hot
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Several salts a partition, as hashing a few would fill some twice.
        salts = F.when(F.col(f"`{fact_key}`").isNull(), F.lit(16 * parts)).otherwise(F.coalesce("_salts", F.lit(1)))
        salted_fact = (
            fact.withColumn("_spread", _spread(fact))
            .join(small, F.col(f"`{fact_key}`") == F.col("_hot_key"), "left")
            .withColumn("_salt", F.pmod("_spread", salts))
            .drop("_spread", "_hot_key", "_salts")
        )
        copies = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1)
        salted_dim = (
            dim.join(small, F.col(f"`{dim_key_col}`") == F.col("_hot_key"), "left")
            .withColumn("_salt", F.explode(copies))
            .drop("_hot_key", "_salts")
        )
        cond = (salted_fact[fact_key] == salted_dim[dim_key_col]) & (salted_fact["_salt"] == salted_dim["_salt"])
        joined = salted_fact.join(salted_dim, cond, how).drop(salted_fact["_salt"]).drop(salted_dim["_salt"])
    if drop_dim_key or same_name:
        joined = joined.drop(dim_key_col)
    return joined


def bounded_lookup(
    small: DataFrame, dim: DataFrame, key: str, dim_key: str, unique=None, how: str = "left", max_rows: int = BROADCAST_MAX_ROWS
) -> DataFrame:
    """``small ⋈ dim`` where ``small`` is meant to be few rows (a top-k
    result). The stored dimension is first reduced to the matching keys with a
    semi join, then ``unique`` (if given) makes the matched rows unique, so
    the dimension never shuffles as a whole. ``small``'s keys and the matched
    rows are broadcast after being measured; beyond the bound (a caller's very
    large k) both joins are left to Spark."""
    keys = small.select(F.col(key).alias("_k")).distinct()
    few = broadcast_ok(keys, max_rows=max_rows)
    matched = dim.join(F.broadcast(keys) if few else keys, dim[dim_key] == keys["_k"], "left_semi")
    matched = unique(matched) if unique else matched
    if few and broadcast_ok(matched, max_rows=max_rows):
        matched = F.broadcast(matched)
    return small.join(matched, small[key] == matched[dim_key], how).drop(matched[dim_key])
