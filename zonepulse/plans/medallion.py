"""The medallion pipeline: raw -> silver -> demand tables -> gold ->
recommendations, each layer written (full overwrite) and read back.

Run it as a job::

    python -m zonepulse.plans.medallion --sf-dir /data/sf1 --out /shared/zonepulse --fixture lineitem

Layout choices for scale:

* silver is written as plain Parquet files with no shuffle: every
  downstream step of the reference aggregates the whole table, so neither
  a sort nor a folder layout pays for itself. For time-filtered consumers,
  ``sort_by=("year", "month", "day")`` sorts within each file (row-group
  statistics then skip data, still no shuffle) and ``partition_by`` (for
  example ``["year", "month"]``) suits raw input that is already clustered
  by time; with time-mixed input it would make every task write into every
  month folder (millions of small files at 100 TB).
* silver is scanned once: its (zone, weekday, hour) cells are stored, and the
  demand tables, zone features, alerts and cluster views come from them.
* gold is built from a zone frame stored once in the checkpoint folder (see ``operators.cluster``)
  and read back before the insights use it; later steps read the stored
  tables, never re-aggregate the trips.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from zonepulse.operators import clean, demand, insights
from zonepulse.operators.cluster import K_RANGE, SEED, Sweep, cluster_zones, sweep_frame
from zonepulse.operators.zones import attach_zone_names, demand_cells, gold_projection, zone_features
from zonepulse.plans import inputs
from zonepulse.session import build_session, ensure_checkpoint_dir, materialize
from zonepulse.sources.sinks import readback_check, write_and_check, write_table
from zonepulse.sources.tables import scan

TIME_SORT = ("year", "month", "day")
TABLES = (
    "silver", "hourly_demand", "dow_demand", "heatmap", "kmeans_sweep", "gold_vectors", "gold", "recommendations",
    "demand_alerts", "cluster_summary", "cluster_roles", "cluster_peak_hours", "cluster_dayparts",
    "cluster_recommendations",
)


def write_silver(
    silver: DataFrame,
    target: str,
    partition_by: Sequence[str] | None = None,
    sort_by: Sequence[str] | None = None,
) -> DataFrame:
    """K2 + K8: write silver and return the verified, re-scanned table."""
    laid_out = silver.sortWithinPartitions(*sort_by) if sort_by else silver
    rows = write_table(laid_out, target, partition_by=partition_by)
    return readback_check(silver.sparkSession, target, silver, rows).select(*silver.columns)


def build_gold(
    silver: DataFrame,
    zone_dim: DataFrame,
    ks: Sequence[int] = K_RANGE,
    seed: int = SEED,
    scale: bool = False,
) -> tuple[DataFrame, DataFrame, Sweep]:
    """G6 -> M1..M7 -> J1 -> P6. Returns (gold, clustered zones with their
    feature vectors, sweep). ``silver`` may be the trips or their cells."""
    clustered, sweep = cluster_zones(zone_features(silver), ks=ks, seed=seed, scale=scale, keep_features=True)
    gold = gold_projection(attach_zone_names(clustered.drop("features"), zone_dim))
    return gold, clustered, sweep


def run_medallion(
    spark: SparkSession,
    raw: DataFrame,
    zone_dim: DataFrame,
    out_base: str,
    partition_by: Sequence[str] | None = None,
    ks: Sequence[int] = K_RANGE,
    seed: int = SEED,
    scale: bool = False,
) -> dict[str, str]:
    """Build and store every layer under ``out_base``; returns the table
    locations. Each layer is read back from storage before the next one
    uses it, so lineage stays short and a lost executor only recomputes
    the current layer."""
    ensure_checkpoint_dir(spark)
    loc = {name: os.path.join(out_base, name) for name in TABLES}

    silver = write_silver(clean.clean_trips(raw), loc["silver"], partition_by=partition_by)
    cells = materialize(demand_cells(silver), "demand-cells")

    write_table(demand.hourly_demand(cells), loc["hourly_demand"])
    write_table(demand.dow_demand(cells), loc["dow_demand"])
    write_table(demand.hour_dow_heatmap(cells), loc["heatmap"])

    gold, vectors, sweep = build_gold(cells, zone_dim, ks=ks, seed=seed, scale=scale)
    write_table(sweep_frame(spark, sweep), loc["kmeans_sweep"])
    write_table(vectors, loc["gold_vectors"])  # K5: zones, features vector, cluster
    gold = write_and_check(spark, gold, loc["gold"])

    write_table(insights.recommendations(gold), loc["recommendations"])
    write_table(insights.demand_alerts(cells), loc["demand_alerts"])
    write_table(insights.cluster_summary(gold), loc["cluster_summary"])
    write_table(insights.cluster_roles(gold), loc["cluster_roles"])
    write_table(insights.cluster_peak_hours(cells, gold), loc["cluster_peak_hours"])
    write_table(insights.cluster_daypart_share(cells, gold), loc["cluster_dayparts"])
    write_table(insights.cluster_recommendations(cells, gold), loc["cluster_recommendations"])
    return loc


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="zonepulse medallion pipeline")
    parser.add_argument("--sf-dir", required=True, help="folder with the source Parquet tables")
    parser.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    parser.add_argument("--fixture", default="lineitem", choices=inputs.FIXTURES)
    parser.add_argument("--partition-by", default="", help="comma list, e.g. year,month")
    parser.add_argument("--scale", action="store_true", help="standardise features before K-Means")
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)
    spark = build_session(args.master)
    raw = inputs.raw_trips(spark, args.sf_dir, args.fixture)
    parts = [c for c in args.partition_by.split(",") if c] or None
    loc = run_medallion(spark, raw, inputs.zones(spark, args.sf_dir), args.out, partition_by=parts, scale=args.scale)
    for name, path in loc.items():
        print(f"{name}\t{path}\t{scan(spark, path).count()} rows")


if __name__ == "__main__":
    main()
