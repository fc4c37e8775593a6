"""Refresh by day (K2-K4, K6): additive cells, rewritten only where days changed.

The store holds (day, zone, weekday, hour) cells with counts and sums, one
folder per calendar day, or per month for thin data (``unit``). A delivery
brings the whole of some days, new or corrected; only their folders are
rewritten (dynamic partition overwrite), with the trips of other days never
read. Demand tables, zone features and alerts
come from the stored cells, which are merged over the days: the cells add up,
so a refresh equals a full rebuild.

A delivered day without a valid trip leaves a marker row with a zero count, so
that its old cells go. Trips without a date belong to the day NULL, whose
folder is Hive's default partition, and are refreshed like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.operators.clean import clean_trips
from zonepulse.operators.zones import ZONE_MEANS

DAY = ("year", "month", "day")
MONTH = ("year", "month")
SUMMED = ["trip_count", *[f"{kind}_{name}" for name in ZONE_MEANS for kind in ("sum", "n")]]
CELL = ["pickup_location_id", "day_of_week", "hour_of_day"]


def day_cells(silver: DataFrame) -> DataFrame:
    """Trips by (day, zone, weekday, hour) with sums and numbers of values of
    the averaged measures; at most zones x 24 rows a day."""
    sums = [
        f(source).alias(f"{kind}_{name}") for name, source in ZONE_MEANS.items() for kind, f in (("sum", F.sum), ("n", F.count))
    ]
    return silver.groupBy(*DAY, *CELL).agg(F.count(F.lit(1)).alias("trip_count"), *sums)


def merged_cells(stored: DataFrame) -> DataFrame:
    """The store's cells added up over the days, in the form of
    ``zones.demand_cells``, which all demand tables and zone features read."""
    return stored.where("trip_count > 0").groupBy(*CELL).agg(*[F.sum(c).alias(c) for c in SUMMED])


def refresh(delivered: DataFrame, store: str, unit: Sequence[str] = DAY) -> DataFrame:
    """Clean the raw trips of the delivered units (each whole) and put their
    cells in place of the stored ones; the first delivery makes the store.
    Returns the store. One task writes a unit: a day holds at most zones x 24
    cells, whatever its trips."""
    spark = delivered.sparkSession
    cells = day_cells(clean_trips(delivered))
    units = delivered.select(*[F.col(c).alias(f"_{c}") for c in unit]).distinct()
    same = reduce(and_, [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in unit])
    # Units of which no trip is valid, one marker row each.
    markers = units.join(cells.select(*unit).distinct(), same, "left_anti").select(
        *[F.col(f"_{c}").alias(c) for c in unit], F.lit(0).cast("bigint").alias("trip_count")
    )
    whole = cells.unionByName(markers, allowMissingColumns=True).repartition(*unit)
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*unit).parquet(store)
    # Folder names hold no types: take them from the trips.
    return spark.read.schema(cells.schema).parquet(store)
