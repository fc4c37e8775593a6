"""Sinks (K1-K8): full-overwrite writes with a read-back check.

A target is a folder (written as Parquet) or a catalog table name
(``saveAsTable``). Writes may be partitioned (for example silver by
``year, month``) so later scans prune partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zonepulse.sources.tables import is_path, scan


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Write ``df`` and return the number of rows written.

    The count is an observed metric of the write job itself
    (``DataFrame.observe``), so verifying it costs no second pass.
    """
    observation = Observation(f"write-{uuid.uuid4().hex[:8]}")
    observed = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(target):
        writer.parquet(target)
    else:
        writer.saveAsTable(target)
    return int(observation.get["rows"])


def readback_check(
    spark: SparkSession, target: str, expected: DataFrame, expected_rows: int | None = None
) -> DataFrame:
    """K8: re-scan ``target`` and assert it has the written columns, types
    and row count. Names/types are compared order-insensitively because a
    partitioned Parquet folder lists partition columns last.
    ``expected_rows`` (from ``write_table``) avoids recomputing
    ``expected``; without it the expected frame is counted."""
    stored = scan(spark, target)
    want = sorted((f.name, f.dataType.simpleString()) for f in expected.schema.fields)
    got = sorted((f.name, f.dataType.simpleString()) for f in stored.schema.fields)
    if want != got:
        raise AssertionError(f"schema of {target} differs: {got} != {want}")
    n_expected = expected.count() if expected_rows is None else expected_rows
    n_stored = stored.count()
    if n_stored != n_expected:
        raise AssertionError(f"{target}: {n_stored} rows stored, {n_expected} expected")
    return stored


def write_and_check(
    spark: SparkSession,
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """Overwrite ``target`` with ``df`` and return the verified re-scan.

    Overwriting a table that the plan itself reads fails in Spark; callers
    write derived layers to new targets (raw -> silver -> gold).
    """
    rows = write_table(df, target, partition_by=partition_by)
    return readback_check(spark, target, df, rows)


def bronze_clone(spark: SparkSession, source: str, target: str) -> DataFrame:
    """K1: copy the raw table unchanged into the bronze layer."""
    raw = scan(spark, source)
    return write_and_check(spark, raw, target)
