"""Scans (S1-S4): a table is named either by a folder of Parquet files or by
a catalog name. Catalyst prunes columns and pushes filters into either."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Test tables shipped with the fixtures (one Parquet file each).
TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def is_path(location: str) -> bool:
    return "/" in location or "://" in location


def table_location(base: str, name: str) -> str:
    """``base`` is a folder (``/data/sf1``) or a catalog namespace
    (``spark_catalog.default``)."""
    if is_path(base):
        return f"{base.rstrip('/')}/{name}.parquet"
    return f"{base}.{name}" if base else name


def scan(spark: SparkSession, location: str) -> DataFrame:
    """Read a Parquet folder/file or a catalog table."""
    if is_path(location):
        return spark.read.parquet(location)
    return spark.table(location)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return scan(spark, table_location(base, name))
