"""Zone clustering: K-Means on zone features (M1-M7, R6), canonical labels.

Labels, silhouettes and the chosen K depend on the data and the zone keys
alone, never on how rows lie in partitions, so a fit uses as many tasks as its
input has. Centres are seeded by distance-weighted sampling whose random
numbers are hashes of the zone key; Lloyd iterations then run as one
aggregation each, over sums in decimals, which are the same in any order. The
centres (K rows) travel as literals of the plan. Features are rounded
(removing summation-order noise of the averages) and stored once in the shared
checkpoint folder (a lineage cut that survives executor loss); the vectors are
persisted for the sweep. Cluster ids are finally renumbered by demand so they
mean the same thing on every run.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.operators.zones import FEATURE_COLUMNS
from zonepulse.session import materialize

# The K range of the sweep, the seed, feature rounding.
K_RANGE = (3, 4, 5, 6)
SEED = 42
ROUND_DIGITS = 9
# Lloyd iterations and the squared movement that ends them.
MAX_ITER = 20
TOLERANCE = 1e-8
# Silhouettes are compared after rounding: summation order moves the last bits.
SCORE_DIGITS = 9


def stable_features(
    zone_frame: DataFrame,
    key: str = "pickup_location_id",
    columns: Sequence[str] = FEATURE_COLUMNS,
    digits: int = ROUND_DIGITS,
    partitions: int | None = None,
) -> DataFrame:
    """Round features and store them once (shared checkpoint folder).
    ``partitions`` deals the zones into so many tasks, else their size does;
    no result depends on it."""
    rounded = zone_frame.select(
        key,
        *[
            (F.round(F.col(c), digits) if dict(zone_frame.dtypes)[c] == "double" else F.col(c)).alias(c)
            for c in columns
        ],
    )
    stored = materialize(rounded, "zone-features")
    return stored.repartition(partitions, key) if partitions else stored


def assemble_features(
    zone_frame: DataFrame,
    columns: Sequence[str] = FEATURE_COLUMNS,
    output: str = "features",
    handle_invalid: str = "skip",
    scale: bool = False,
) -> DataFrame:
    """M1 (+ R6): feature vector of the complete rows. ``handle_invalid='skip'``
    leaves out zones with a NULL feature (for example all fares NULL), which
    cannot enter a distance; ``cluster_zones`` puts them back without a
    cluster. ``'error'`` reproduces the strict behaviour. ``scale`` standardises
    each feature (mean 0, unit variance) so that ``total_trips`` does not
    dominate the distances."""
    raw_col = f"{output}_raw" if scale else output
    assembled = VectorAssembler(
        inputCols=list(columns), outputCol=raw_col, handleInvalid=handle_invalid
    ).transform(zone_frame)
    if not scale:
        return assembled
    scaler = StandardScaler(inputCol=raw_col, outputCol=output, withMean=True, withStd=True)
    return scaler.fit(assembled).transform(assembled).drop(raw_col)


Centre = tuple[float, ...]


def _distances(centres: Sequence[Centre]) -> Column:
    """(d, i) of ``x`` and every centre: squared Euclidean distance, number.
    The centres are one array literal, which Spark's generated code refers to,
    so iterations with other centres compile nothing anew."""
    table = F.array(*[F.array(*[F.lit(v) for v in c]) for c in centres])

    def of_centre(centre: Column, i: Column) -> Column:
        squares = F.zip_with("x", centre, lambda a, b: (a - b) * (a - b))
        return F.struct(F.aggregate(squares, F.lit(0.0), lambda total, v: total + v).alias("d"), i.alias("i"))

    return F.transform(table, of_centre)


def _nearest(centres: Sequence[Centre]) -> Column:
    """The nearest centre's number; the first of equally near ones."""
    return F.array_min(_distances(centres)).getField("i")


def _points(vectors: DataFrame, key: str) -> DataFrame:
    return vectors.select(F.col(key).alias("zone"), vector_to_array("features").alias("x"))


def seed_centres(vectors: DataFrame, k: int, seed: int = SEED, key: str = "pickup_location_id") -> list[Centre]:
    """Up to ``k`` distinct points, each next one drawn with a chance in
    proportion to its squared distance to those before (k-means++). The draw
    is the least of -ln(u) / weight, u a hash of the zone key: one top-1 job
    a centre, and the same points under any layout. The first centres of a
    larger ``k`` are those of a smaller one."""
    points = _points(vectors, key)
    found: list[Centre] = []
    while len(found) < k:
        hashed = F.pmod(F.xxhash64(F.lit(seed), F.lit(len(found)), "zone"), F.lit(1 << 52))
        u = (hashed.cast("double") + 0.5) / float(1 << 52)
        weight = F.array_min(_distances(found)).getField("d") if found else F.lit(1.0)
        drawn = points.withColumn("w", weight).where("w > 0").withColumn("at", -F.log(u) / F.col("w"))
        row = drawn.orderBy("at", "zone", "x").select("x").first()
        if row is None:
            break
        found.append(tuple(row["x"]))
    return found


@dataclass(frozen=True)
class Centres:
    """A fitted K-Means model: its centres."""

    centres: tuple[Centre, ...]

    def clusterCenters(self) -> list[Centre]:  # noqa: N802 (named as Spark's models name it)
        return list(self.centres)

    def transform(self, vectors: DataFrame) -> DataFrame:
        assigned = vectors.withColumn("x", vector_to_array("features"))
        return assigned.withColumn("prediction", _nearest(self.centres).cast("int")).drop("x")


def fit_all(vectors: DataFrame, starts: dict[int, Sequence[Centre]], max_iter: int = MAX_ITER, key: str = "pickup_location_id") -> dict[int, Centres]:
    """Lloyd iterations of several models at once, by K. One iteration is one
    aggregation over the points for all models that still move, with map-side
    partial sums and one row of result a centre; decimal sums make it exact. A
    centre that loses all its zones stays where it is."""
    points = _points(vectors, key)
    now = {k: list(centres) for k, centres in starts.items()}
    moving = set(now)
    for _ in range(max_iter):
        if not moving:
            break
        found = [F.struct(F.lit(k).alias("k"), _nearest(now[k]).alias("i")) for k in sorted(moving)]
        cells = points.select("x", F.explode(F.array(*found)).alias("c"))
        dims = range(len(next(iter(now.values()))[0]))
        sums = [F.sum(F.col("x")[i].cast(f"decimal(38,{ROUND_DIGITS})")).alias(f"s{i}") for i in dims]
        new = {k: list(now[k]) for k in moving}
        for row in cells.groupBy("c.k", "c.i").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
            new[row["k"]][row["i"]] = tuple(float(s / row["n"]) for s in row[3:])
        for k in sorted(moving):
            shift = max(sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for x, y in zip(now[k], new[k], strict=True))
            if shift <= TOLERANCE:
                moving.discard(k)
            now[k] = new[k]
    return {k: Centres(tuple(centres)) for k, centres in now.items()}


def fit_kmeans(
    vectors: DataFrame, k: int, seed: int = SEED, max_iter: int = MAX_ITER, key: str = "pickup_location_id"
) -> Centres:
    """M2: K-Means with the reference's defaults (20 iterations, squared
    Euclidean distance) from seeded centres."""
    return fit_all(vectors, {k: seed_centres(vectors, k, seed, key)}, max_iter, key)[k]


def silhouette(predictions: DataFrame) -> float | None:
    """M4: mean silhouette (squared Euclidean); None with fewer than two
    non-empty clusters, where it is undefined."""
    if predictions.select("prediction").distinct().limit(2).count() < 2:
        return None
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    return round(float(evaluator.evaluate(predictions)), SCORE_DIGITS)


@dataclass
class Sweep:
    results: list[tuple[int, float | None]]
    best_k: int
    best_model: Centres | None
    #: Zones with a NULL feature: kept, but in no cluster.
    incomplete: int = 0


def distinct_points(vectors: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> int:
    return vectors.select(*columns).distinct().count()


def k_sweep(
    vectors: DataFrame,
    ks: Sequence[int] = K_RANGE,
    seed: int = SEED,
    columns: Sequence[str] = FEATURE_COLUMNS,
    parallelism: int | None = None,
    key: str = "pickup_location_id",
) -> Sweep:
    """M5 + M6: fit every K, score by silhouette, keep the best model
    (highest silhouette; the smallest K wins ties). All K share the seeds and
    one aggregation per iteration; the evaluations, independent jobs over the
    persisted vectors, are submitted concurrently from ``parallelism`` driver
    threads (as ``CrossValidator(parallelism=...)`` does).

    A K larger than the number of distinct points has no K centres; it is
    reported with no score."""
    points = distinct_points(vectors, columns)
    fittable = [k for k in ks if k <= points]
    seeds = seed_centres(vectors, max(fittable), seed, key) if fittable else []
    models = fit_all(vectors, {k: seeds[:k] for k in fittable}, key=key)
    workers = max(1, min(parallelism or len(fittable) or 1, len(fittable) or 1))
    with ThreadPoolExecutor(max_workers=workers) as pool:
        scores = dict(zip(fittable, pool.map(lambda k: silhouette(models[k].transform(vectors)), fittable)))
    results: list[tuple[int, float | None]] = []
    best: tuple[int, float, Centres] | None = None
    for k in ks:  # ascending order of the caller: the first maximum wins
        score, model = scores.get(k), models.get(k)
        results.append((k, score))
        if score is not None and (best is None or score > best[1]):
            best = (k, score, model)
    if best is None:
        # No K could be scored: fewer points than every K. Use one cluster
        # per distinct point (K-Means needs K >= 2; a single point is
        # cluster 0 without a model).
        if points < 2:
            return Sweep(results=results, best_k=1, best_model=None)
        k0 = min(min(ks), points)
        best = (k0, float("nan"), fit_kmeans(vectors, k0, seed, key=key))
    return Sweep(results=results, best_k=best[0], best_model=best[2])


def relabel_by_demand(clustered: DataFrame, key: str = "pickup_location_id") -> DataFrame:
    """Renumber clusters 0..K-1 by mean ``total_trips`` (descending), ties
    by the smallest member zone id, so that ids are independent of K-Means
    internals. The mapping frame has K rows (broadcast by construction)."""
    stats = clustered.where("prediction IS NOT NULL").groupBy("prediction").agg(
        F.avg("total_trips").alias("_mean"), F.min(key).alias("_first")
    )
    # K rows: a single-partition window is bounded by K.
    order = Window.orderBy(F.desc("_mean"), F.asc("_first"))
    mapping = stats.select(
        F.col("prediction").alias("_old"), (F.row_number().over(order) - 1).cast("int").alias("_new")
    )
    return (
        clustered.join(F.broadcast(mapping), clustered["prediction"] == mapping["_old"], "left")
        .drop("prediction", "_old")
        .withColumnRenamed("_new", "prediction")
    )


def cluster_zones(
    zone_frame: DataFrame,
    ks: Sequence[int] = K_RANGE,
    seed: int = SEED,
    scale: bool = False,
    canonical_labels: bool = True,
    key: str = "pickup_location_id",
    keep_features: bool = False,
    partitions: int | None = None,
) -> tuple[DataFrame, Sweep]:
    """M7: zones with an int ``prediction`` from the best K of the sweep
    (the sweep's model is reused, not refitted). Zones with a NULL feature
    stay, with a NULL ``prediction``; ``Sweep.incomplete`` counts them.
    ``keep_features`` keeps the assembled ``features`` vector column."""
    stable = stable_features(zone_frame, key, partitions=partitions)
    vectors = assemble_features(stable, scale=scale).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sweep = k_sweep(vectors, ks, seed, key=key)
        if sweep.best_model is None:
            clustered = vectors.withColumn("prediction", F.lit(0))
        else:
            clustered = sweep.best_model.transform(vectors).withColumn(
                "prediction", F.col("prediction").cast("int")
            )
        labelled = clustered.select(key, *(["features"] if keep_features else []), "prediction")
        # Both sides have one row per zone.
        clustered = materialize(stable.join(labelled, key, "left"), "zone-clusters")
        sweep.incomplete = clustered.where("prediction IS NULL").count()
    finally:
        vectors.unpersist()
    if canonical_labels:
        clustered = relabel_by_demand(clustered, key)
    return clustered, sweep


def sweep_frame(spark, sweep: Sweep) -> DataFrame:
    """The sweep as a small DataFrame: ``k, silhouette, chosen``."""
    rows = [(k, s, k == sweep.best_k) for k, s in sweep.results]
    return spark.createDataFrame(rows, "k int, silhouette double, chosen boolean")
