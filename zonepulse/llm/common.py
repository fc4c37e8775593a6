"""Helpers that several operators share: normalised text, a bounded
membership filter and a lookup that survives hot groups."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import zonepulse
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.session import materialize

#: White space of the contracts: space, tab, line feed, VT, FF, CR.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

#: Bits of a membership filter. It is broadcast as at most FILTER_BITS / 64
#: rows of (int, long) whatever the input: about 1M rows, some 32 MB.
FILTER_BITS = 1 << 26

stored = materialize


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application:
    an archive of its sources that Spark's own file distribution carries."""
    sc = spark.sparkContext
    if not getattr(sc, "_zonepulse_shipped", False):
        root = Path(zonepulse.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="zonepulse-code-")) / "zonepulse.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        sc.addPyFile(str(archive))
        sc._zonepulse_shipped = True


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def normalised(column: str = "text") -> Column:
    """The text with each run of white space replaced by one space."""
    return F.regexp_replace(text_of(column), SPACES, " ")


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _word(h: Column, bits: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 6), F.lit(bits // 64)).cast("int")


def _bit(h: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(h, F.lit(64)).cast("int"))


def prefix_sums(numbers: Column) -> Column:
    """Sums of an int array up to and with each place, by doubling: n log n
    steps for n numbers, where ``aggregate`` with a growing array takes n^2."""
    doublings = F.ceil(F.log2(F.size(numbers))).cast("int")
    steps = F.when(
        F.size(numbers) > 1,
        F.transform(F.sequence(F.lit(0), doublings - 1), lambda k: F.call_function("shiftleft", F.lit(1), k)),
    ).otherwise(F.array().cast("array<int>"))

    def further(sums: Column, step: Column) -> Column:
        moved = F.concat(
            F.array_repeat(F.lit(0), F.least(step, F.size(sums))),
            F.slice(sums, F.lit(1), F.greatest(F.size(sums) - step, F.lit(0))),
        )
        return F.zip_with(sums, moved, lambda a, b: a + b)

    return F.aggregate(steps, numbers, further)


def bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it stands there."""
    return F.element_at(F.transform(F.array(value), body), 1)


def member_filter(hashes: DataFrame, h: str, bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter with one hash function over the long column ``h``, as
    rows (word, mask). The union over tasks is a map-side combined bit_or;
    there are at most ``bits / 64`` rows, which bounds its broadcast."""
    return hashes.groupBy(_word(F.col(h), bits).alias("_w")).agg(F.bit_or(_bit(F.col(h))).alias("_mask"))


def probe(rows: DataFrame, h: str, members: DataFrame, flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` plus the boolean ``flag``: false only for rows whose ``h`` is
    surely not in ``members``. A full filter makes every flag true, so
    results never depend on its size, only the work after it."""
    marked = rows.withColumn("_w", _word(F.col(h), bits)).join(F.broadcast(members), "_w", "left")
    return marked.withColumn(
        flag, F.coalesce(F.col("_mask").bitwiseAND(_bit(F.col(h))) != 0, F.lit(False))
    ).drop("_w", "_mask")


def attach_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` inner joined to ``groups``, one row per ``keys`` (none null)
    that holds the number of its rows in ``size``.

    A group larger than a mean shuffle partition could fill a task by
    itself. At most as many groups as there are partitions can be that
    large, so those are broadcast and their rows stay where they are; the
    rest shuffle, and no key among them exceeds a mean partition. Both
    frames should be stored copies, as each is read twice.
    """
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    total = groups.agg(F.sum(size)).first()[0] or 0
    big = F.col(size) > F.lit(max(1000, total // parts))
    hot = F.broadcast(groups.where(big))
    cold = rows.join(F.broadcast(groups.where(big).select(*keys)), keys, "left_anti").join(
        groups.where(~big), keys
    )
    return cold.unionByName(rows.join(hot, keys).select(*cold.columns))
