"""J2 beyond the broadcast bound, without an exchange at read.

``write_bucketed`` stores facts in a table bucketed and sorted by (key, part),
``write_bucketed_dimension`` the dimension with the same buckets, and
``bucketed_join`` joins the two bucket by bucket: the shuffle is paid once, at
write time, and each later join of the layer reads co-located files. A key with
more than ``rows_per_part`` facts gets ``ceil(rows / rows_per_part)`` parts,
which fall into buckets of their own, and only its dimension row is repeated.

Defined cases: a null key has no match and keeps its facts, whose parts are
spread over the buckets; facts without a dimension row keep nulls (``left``);
a dimension key is cast to the facts' type, and one that does not fit has no
match; columns beside the key pass through, but none may be named like ``PART``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.plans.joins import ROWS_PER_SALT, _spread, broadcast_ok, salted_keys
from zonepulse.session import materialize, scratch_dir

PART = "key_part"


@dataclass(frozen=True)
class Bucketed:
    """A stored layer: the table of facts, how they were bucketed, and the
    keys that have several parts."""

    table: str
    key: str
    buckets: int
    hot: DataFrame

    def facts(self) -> DataFrame:
        return self.hot.sparkSession.table(self.table)


def _save(df: DataFrame, table: str, key: str, buckets: int, path: str | None) -> None:
    """One file a bucket: rows meet in the writer's own partitioning, the one
    that ``bucketBy`` uses for its files."""
    writer = df.repartition(buckets, key, PART).write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(buckets, key, PART).sortBy(key, PART)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_bucketed(
    fact: DataFrame, table: str, key: str, buckets: int, path: str | None = None, rows_per_part: int = ROWS_PER_SALT
) -> Bucketed:
    """Store ``fact`` as ``table``. ``path`` makes it an external table (by
    default it lies in the warehouse). The counted table of hot keys holds at
    most ``rows / rows_per_part`` rows and is broadcast after being measured."""
    if PART in fact.columns:
        raise ValueError(f"{PART} is the name of the part column")
    spark = fact.sparkSession
    hot = materialize(salted_keys(fact, key, rows_per_part), "bucket-parts")
    small = F.broadcast(hot) if broadcast_ok(hot) else hot
    parts = F.when(F.col(f"`{key}`").isNull(), F.lit(16 * buckets)).otherwise(F.coalesce("_salts", F.lit(1)))
    spread = (
        fact.withColumn("_spread", _spread(fact))
        .join(small, F.col(f"`{key}`") == F.col("_hot_key"), "left")
        .withColumn(PART, F.pmod("_spread", parts).cast("int"))
        .select(*[F.col(f"`{c}`") for c in fact.columns], PART)
    )
    _save(spread, table, key, buckets, path)
    return Bucketed(table, key, buckets, hot)


def write_bucketed_dimension(layer: Bucketed, dim: DataFrame, table: str, dim_key: str, path: str | None = None) -> DataFrame:
    """Store ``dim``, unique on ``dim_key``, with the buckets of ``layer``: a
    row for each part of its key."""
    small = F.broadcast(layer.hot) if broadcast_ok(layer.hot) else layer.hot
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)).cast("int") - 1))
    # Equal keys of different types would fall into different buckets.
    kind = layer.facts().schema[layer.key].dataType
    typed = dim.withColumn(dim_key, F.col(f"`{dim_key}`").try_cast(kind))
    rows = (
        typed.join(small, F.col(f"`{dim_key}`") == F.col("_hot_key"), "left")
        .select(*[F.col(f"`{c}`") for c in dim.columns], copies.alias(PART))
    )
    _save(rows, table, dim_key, layer.buckets, path)
    return dim.sparkSession.table(table)


def bucketed_join(layer: Bucketed, dim: DataFrame, dim_key: str, how: str = "left") -> DataFrame:
    """Facts of ``layer`` joined to a dimension of ``write_bucketed_dimension``;
    the plan has no exchange, as both sides are bucketed alike."""
    fact = layer.facts()
    right = dim.select(*[F.col(f"`{c}`").alias(f"_dim_{c}") for c in dim.columns])
    match = (fact[layer.key] == right[f"_dim_{dim_key}"]) & (fact[PART] == right[f"_dim_{PART}"])
    given = [F.col(f"`_dim_{c}`").alias(c) for c in dim.columns if c not in (dim_key, PART)]
    return fact.join(right.hint("merge"), match, how).select(*[fact[c] for c in fact.columns if c != PART], *given)


def scratch_tables(fact: DataFrame, key: str, dim: DataFrame, dim_key: str, buckets: int, **bounds) -> tuple[Bucketed, DataFrame]:
    """Both sides as external tables under the shared checkpoint folder."""
    spark = fact.sparkSession
    paths = [scratch_dir(spark, f"bucketed-{side}") for side in ("facts", "dim")]
    names = [f"zonepulse_{p.rsplit('/', 1)[1].replace('-', '_')}" for p in paths]
    layer = write_bucketed(fact, names[0], key, buckets, paths[0], **bounds)
    return layer, write_bucketed_dimension(layer, dim, names[1], dim_key, paths[1])
