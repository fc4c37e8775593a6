"""Exact top-k search by tiled matrix products.

Vectors are quantised and packed into tiles where they lie: blocks of up to
``TILE`` candidates and of up to ``QUERY_TILE`` queries of one dimension, each
one row. Shards are groups of candidate tiles; every query tile visits every
shard through an equi-join on the shard number, so the work is dealt by pairs
of tiles and no task holds more than a few of them. For each pair a task
multiplies the two blocks, selects the k best of every query from the product,
and merges what the pairs of one query tile leave. The lists of all tasks meet
in a tree: first by query and task group, then by query.

A component x becomes floor(1024 x), the score is the integer inner product,
exact: blocks whose products could leave the 53 bits of a double are
multiplied as Python integers, and a score beyond a long is held at its bound.

Defined cases: vectors that are null or hold a null or non-finite component,
and rows with a null id, take no part; vectors of different dimension do not
meet; a query meets every row but those with its own id; of repeated ids each
row is a candidate, and each query row is answered; equal scores go to the
smaller id; with fewer than k candidates all are returned; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import ship, stored

SCALE = 1024
TILE = 4096
QUERY_TILE = 512
#: Lists of one query that meet in the last step of the tree.
FAN_IN = 64
#: Query tiles whose lists a task holds before it passes them on.
HELD_TILES = 64
LONG = 2**63 - 1

TILE_SCHEMA = "tile long, dim int, ids binary, kind string, cells binary"


def quantised(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Rows that take part by dimension: (dimension of each row or -1, cells)."""
    n = len(vectors)
    lengths = np.array([-1 if x is None else x for x in pa.compute.list_value_length(vectors).to_pylist()], np.int64)
    flat = vectors.flatten()  # without the values of null lists
    values = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    begins = np.concatenate(([0], np.cumsum(np.maximum(lengths, 0))))[:n]
    dims, cells = np.full(n, -1), {}
    for d in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == d)
        block = values[begins[rows][:, None] + np.arange(d)] if d else np.zeros((len(rows), 0))
        with np.errstate(over="ignore"):
            block = np.floor(block * float(scale))
        fine = np.isfinite(block).all(axis=1)
        dims[rows[fine]] = d
        cells[int(d)] = block[fine]
    return dims, cells


def _packed(tile: int, dim: int, ids: np.ndarray, block: np.ndarray) -> tuple:
    order = np.argsort(ids, kind="stable")
    top = np.abs(block).max(initial=0)
    kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<f8"
    return tile, dim, ids[order].astype("<i8").tobytes(), kind, np.ascontiguousarray(block[order]).astype(kind).tobytes()


def tiles(rows: DataFrame, size: int, scale: int = SCALE) -> DataFrame:
    """(id, vector) rows as tiles of at most ``size`` rows, in place."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        base, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            dims, cells = quantised(batch.column(1), scale)
            for d, block in cells.items():
                old = held.get(d, (np.zeros(0, np.int64), np.zeros((0, d))))
                all_ids, all_cells = np.concatenate((old[0], ids[dims == d])), np.concatenate((old[1], block))
                while len(all_ids) >= size:
                    yield _tiles([_packed(base + made, d, all_ids[:size], all_cells[:size])])
                    all_ids, all_cells, made = all_ids[size:], all_cells[size:], made + 1
                held[d] = (all_ids, all_cells)
        rest = [(d, x) for d, x in sorted(held.items()) if len(x[0])]
        if rest:
            yield _tiles([_packed(base + made + k, d, *x) for k, (d, x) in enumerate(rest)])

    return rows.mapInArrow(of_batches, TILE_SCHEMA)


def _tiles(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.binary())
    names = ["tile", "dim", "ids", "kind", "cells"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*found, strict=True), kinds, strict=True)], names)


def product(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """All inner products, exact (float64 holding integers, or objects)."""
    a, b = queries.astype(np.float64), block.astype(np.float64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < 2**53:
        return a @ b.T
    whole = np.frompyfunc(int, 1, 1)
    out = np.dot(whole(a).astype(object), whole(b).astype(object).T)
    return np.where(out > LONG, LONG, np.where(out < -LONG, -LONG, out))


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row: (row, id, score). ``ids`` ascend along the
    columns, so of equal scores at the limit the first columns win. Cells of
    minus infinity take no part."""
    if scores.shape[1] > k:
        limit = np.partition(scores, -k, axis=1)[:, -k][:, None]
        above, equal = scores > limit, scores == limit
        room = k - above.sum(axis=1, keepdims=True)
        chosen = above | (equal & (np.cumsum(equal, axis=1) <= room))
    else:
        chosen = np.ones(scores.shape, bool)
    chosen &= scores != -np.inf
    row, column = np.nonzero(chosen)
    return row, ids[column], scores[row, column]


def _best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row from lists: by score down, then id."""
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    first = np.searchsorted(rows, rows, "left")
    fine = np.arange(len(rows)) - first < k
    return rows[fine], ids[fine], scores[fine]


def _cells(kind: str, cells: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(cells, kind).reshape(n, dim)


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows where the Column
    ``is_query`` over ``id`` holds, against all rows."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    asked = rows.where(is_query)
    parts = max(1, -(-asked.count() // QUERY_TILE))
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = stored(tiles(rows, TILE), "topk-tiles").withColumn("shard", F.pmod(F.xxhash64("tile"), F.lit(shards)))
    queries = stored(tiles(asked.repartition(parts), QUERY_TILE), "topk-queries").select(
        F.col("tile").alias("q_tile"),
        "dim",
        F.col("ids").alias("q_ids"),
        F.col("kind").alias("q_kind"),
        F.col("cells").alias("q_cells"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
    )
    pairs = blocks.join(queries, ["shard", "dim"]).select(
        "dim", "ids", "kind", "cells", "q_tile", "q_ids", "q_kind", "q_cells"
    )

    def of_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        node = TaskContext.get().partitionId()

        def passed_on() -> Iterator[pa.RecordBatch]:
            for tile, (q_ids, row, ids, scores) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row.astype(np.int64) + tile * QUERY_TILE),
                        pa.array(q_ids[row]),
                        pa.array(np.full(len(row), node, np.int64)),
                        pa.array([-int(x) for x in scores], pa.int64()),
                        pa.array(ids),
                    ],
                    ["query", "query_id", "node", "below", "vec_id"],
                )
            held.clear()

        for batch in batches:
            for at in range(batch.num_rows):
                dim, ids, kind, cells, tile, q_ids, q_kind, q_cells = (c[at].as_py() for c in batch.columns)
                ids, q_ids = np.frombuffer(ids, "<i8"), np.frombuffer(q_ids, "<i8")
                scores = product(_cells(q_kind, q_cells, len(q_ids), dim), _cells(kind, cells, len(ids), dim))
                scores[q_ids[:, None] == ids[None, :]] = -np.inf
                new = select(scores, ids, k)
                if tile in held:
                    new = tuple(np.concatenate(x) for x in zip(held[tile][1:], new, strict=True))
                elif len(held) >= HELD_TILES:
                    yield from passed_on()
                held[tile] = (q_ids, *_best(*new, k))
        yield from passed_on()

    found = pairs.mapInArrow(of_pairs, "query long, query_id long, node long, below long, vec_id long")
    top = F.slice(F.array_sort(F.flatten(F.collect_list("list"))), 1, k).alias("list")
    leaves = found.groupBy("query", "query_id", F.pmod("node", F.lit(FAN_IN)).alias("branch")).agg(
        F.slice(F.array_sort(F.collect_list(F.struct("below", "vec_id"))), 1, k).alias("list")
    )
    return (
        leaves.groupBy("query", "query_id")
        .agg(top)
        .select("query_id", F.posexplode("list").alias("place", "hit"))
        .select(
            "query_id",
            (F.col("place") + 1).cast("int").alias("rank"),
            F.col("hit.vec_id").alias("vec_id"),
            (-F.col("hit.below")).alias("score"),
        )
    )
