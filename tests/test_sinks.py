"""Sinks: overwrite writes, observed row counts, read-back verification."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from zonepulse.session import materialize, passing_copies, remove_copy, scratch_dir
from zonepulse.sources.sinks import bronze_clone, readback_check, write_and_check, write_table
from zonepulse.sources.tables import table_location


def test_write_returns_observed_row_count(spark, tmp_dir):
    df = spark.range(0, 1234).withColumn("g", F.col("id") % 7)
    assert write_table(df, os.path.join(tmp_dir, "t"), partition_by=["g"]) == 1234
    back = write_and_check(spark, df, os.path.join(tmp_dir, "u"))
    assert back.count() == 1234


def test_readback_detects_schema_and_count_mismatch(spark, tmp_dir):
    df = spark.range(0, 10)
    target = os.path.join(tmp_dir, "t")
    rows = write_table(df, target)
    with pytest.raises(AssertionError, match="schema"):
        readback_check(spark, target, df.withColumn("x", F.lit(1)), rows)
    with pytest.raises(AssertionError, match="rows stored"):
        readback_check(spark, target, df, rows + 1)
    # overwrite replaces the previous content
    write_table(spark.range(0, 3), target)
    assert readback_check(spark, target, spark.range(0, 3)).count() == 3


def test_bronze_clone_is_an_exact_copy(spark, tmp_dir):
    source = table_location(SF_SMALL, "lineitem")
    copy = bronze_clone(spark, source, os.path.join(tmp_dir, "bronze"))
    original = spark.read.parquet(source)
    assert copy.count() == original.count()
    assert copy.exceptAll(original).count() == 0


def test_materialize_cuts_lineage_and_keeps_rows(spark):
    df = spark.range(0, 100).withColumn("sq", F.col("id") * F.col("id"))
    stored = materialize(df, "test-copy")
    assert sorted(r.sq for r in stored.collect()) == sorted(r.sq for r in df.collect())
    plan = plan_text(stored)
    assert "Range" not in plan and "Scan parquet" in plan


def test_catalog_tables_round_trip(spark):
    from zonepulse.plans import inputs
    from zonepulse.plans.medallion import write_silver
    from zonepulse.sources.tables import scan

    silver = inputs.silver_trips(spark, SF_SMALL)
    stored = write_silver(silver, "default.zp_silver_trips")  # a managed catalog table
    assert stored.count() == silver.count() == 4903
    assert scan(spark, "default.zp_silver_trips").columns == silver.columns
    write_table(silver.limit(5), "default.zp_silver_trips")  # overwrite replaces it
    assert scan(spark, "default.zp_silver_trips").count() == 5


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_copies_of_a_finished_step_are_deleted(spark):
    kept = scratch_dir(spark, "kept")
    before = folder(materialize(spark.range(3), "before"))
    with passing_copies(spark):
        one = materialize(spark.range(5), "one")
        with passing_copies(spark):
            inner = folder(materialize(one.withColumn("x", F.col("id") + 1), "inner"))
        assert not os.path.exists(inner) and os.path.exists(folder(one))
        gone = folder(one)
        one.write.mode("overwrite").parquet(kept)
    assert not os.path.exists(gone) and os.path.exists(before)
    assert spark.read.parquet(kept).count() == 5
    with pytest.raises(ValueError, match="stop"), passing_copies(spark):
        gone = folder(materialize(spark.range(5), "one"))
        raise ValueError("stop")
    assert not os.path.exists(gone)
    remove_copy(spark, kept)
    remove_copy(spark, kept)
    assert not os.path.exists(kept.removeprefix("file:"))
