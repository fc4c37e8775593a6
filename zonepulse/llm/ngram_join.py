"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of hashed word n-grams (words stand between white space). Rows
of equal sets are folded into one representative with a count, so copies are
never expanded. Representatives carry MinHash values; those that agree in a
band of them share a bucket. Inside a bucket all pairs are compared in numpy,
value after value in steps: a pair is dropped as soon as the posterior
probability (uniform prior) that its similarity reaches the threshold falls
below ``TOLERANCE``; what remains is verified exactly on the sets. A pair
counts in the first band where it agrees, so no pair is met twice.

A bucket of more than ``BLOCK`` members is cut into chunks by hash and
compared chunk against chunk, so no task holds a large bucket. Pairs never
become rows: a task emits, per block, the members and the packed surviving
pairs, and after verification one row per member with its number of links and
the least member of its part. Sets are made again only for texts that
survived, found by a filter of fixed size; the parts are joined by
``components``.

A long text is hashed in pieces between words; its set is held whole (8 bytes a
distinct n-gram). A pair at or above the threshold is lost only if it agrees in no band (below
4e-6 at 0.8) or is pruned (``TOLERANCE`` in each step).

Defined cases: a text of fewer words than n is one n-gram, its words; a text
without words (null, empty) is similar to nothing, a class of its own without
links; null ids come last when a class picks its id; rows equal in id and text
are copies, of which ``dedup_near`` keeps one, if they have words; rows
without words all stay; a threshold below 0.8 is refused; other columns pass through
``dedup_near`` whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import FILTER_BITS, attach_groups, member_filter, probe, ship, stored, text_of
from zonepulse.llm.components import components
from zonepulse.llm.hashing import SPACED, is_long, mixed, text_slices, word_hashes, word_pieces

WORDS = 5
#: A character of a word.
WORD = r"[^\x20\x09-\x0D]"
THRESHOLD = 0.8
BANDS = 24
ROWS = 4
#: MinHash values compared between two looks at the posterior.
STEP = 16
TOLERANCE = 1e-6
BLOCK = 256
#: Pairs that are compared at once, and members whose sets a task verifies at
#: once (twice as many at most).
PAIRS_AT_ONCE = 100_000
PACKET = 512
#: Cells of sets that MinHash values are taken of at once.
CELLS = 1 << 18

_VALUES = BANDS * ROWS
_RNG = np.random.default_rng(20_240_229)
_FACTORS = _RNG.integers(1, 2**63, _VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**63, _VALUES, dtype=np.uint64)
_COMBINE = np.uint64(0xD6E8FEB86659FD93)


def ngram_sets(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sorted n-gram hashes of every row, one after another, and where
    each row's begin."""
    if is_long(offsets):
        own = _long_set(data, n)
        return own, np.array([0, len(own)])
    words, begins, _ = word_hashes(data, offsets, SPACED)
    grams = _grams(words, n)
    sets = []
    for a, b in zip(begins[:-1], begins[1:], strict=True):
        sets.append(_distinct(grams[a : b - n + 1].copy()) if b - a >= n else _short_set(words[a:b]))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum([0, *map(len, sets)])


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words from each word on that has n - 1 followers."""
    m = max(len(words) - n + 1, 0)
    grams = np.zeros(m, np.uint64)
    for k in reversed(range(n)):
        grams = grams * _COMBINE + words[k : k + m]
    return mixed(grams)


def _short_set(words: np.ndarray) -> np.ndarray:
    """The one n-gram of a text of fewer words, none without words."""
    one = np.uint64(0)
    with np.errstate(over="ignore"):
        for w in words[::-1]:
            one = one * _COMBINE + w
    return mixed(np.full(min(1, len(words)), one), len(words))


def _distinct(cells: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorts ``cells`` in place."""
    cells.sort()
    return cells[np.concatenate((np.ones(min(1, len(cells)), bool), cells[1:] != cells[:-1]))]


def _long_set(data: np.ndarray, n: int) -> np.ndarray:
    """The n-gram hashes of one long text, piece by piece; the last n - 1 words
    of a piece are carried into the next one."""
    parts, words = [], np.zeros(0, np.uint64)
    for more, _ in word_pieces(data, SPACED):
        words = np.concatenate((words, more))
        if len(words) >= n:
            parts.append(_distinct(_grams(words, n)))
            words = words[len(words) - n + 1 :]
    if not parts:
        return _short_set(words)
    cells = np.concatenate(parts)
    parts.clear()
    return _distinct(cells)


def set_keys(sets: np.ndarray, begins: np.ndarray) -> list[bytes | None]:
    """128 bits that stand for a whole set; None for the empty one."""
    some = np.flatnonzero(np.diff(begins))
    out: list[bytes | None] = [None] * (len(begins) - 1)
    halves = np.zeros((len(some), 2), np.uint64)
    for part, lo, hi, edges in _stretches(sets, begins[some]):
        for side, seed in enumerate((11, 23)):
            halves[lo:hi, side] += np.add.reduceat(mixed(part, seed), edges)
    for row, half in zip(some, halves.astype(">u8"), strict=True):
        out[row] = half.tobytes()
    return out


def _stretches(sets: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[np.ndarray, int, int, np.ndarray]]:
    """(cells, first set, set after the last, where each of those sets begins in
    the cells): at most ``CELLS`` cells at once. ``firsts`` are the places of
    the first cells, no set being empty."""
    for at in range(0, len(sets), CELLS):
        part = sets[at : at + CELLS]
        lo = int(np.searchsorted(firsts, at, "right")) - 1
        hi = int(np.searchsorted(firsts, at + len(part), "left"))
        yield part, lo, hi, np.maximum(firsts[lo:hi], at) - at


def signatures(sets: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits) of the rows whose sets aren't empty, as least
    values over stretches of cells."""
    firsts = begins[:-1][np.diff(begins) > 0]
    out = np.full((len(firsts), _VALUES), 2**32 - 1, np.uint32)
    for part, lo, hi, edges in _stretches(sets, firsts):
        for k in range(_VALUES):
            least = np.minimum.reduceat((part * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32), edges)
            out[lo:hi, k] = np.minimum(out[lo:hi, k], least.astype(np.uint32))
    return out


def band_hashes(values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band; different bands never share one on purpose."""
    out = np.zeros((len(values), BANDS), np.uint64)
    for band in range(BANDS):
        for k in range(ROWS):
            out[:, band] = mixed(out[:, band] * _COMBINE + values[:, band * ROWS + k], band + 1)
    return out.view(np.int64)


@lru_cache(maxsize=8)
def least_matches(threshold: float, values: int, tolerance: float = TOLERANCE) -> int:
    """The fewest matches among so many values that leave a chance of at least
    ``tolerance``. With a uniform prior the posterior after m of n matches is
    Beta(m + 1, n - m + 1), whose part above t is the chance of at most m
    successes in n + 1 trials of t."""
    total = 0.0
    for m in range(values + 1):
        total += comb(values + 1, m) * threshold**m * (1 - threshold) ** (values + 1 - m)
        if total >= tolerance:
            return m
    return values


def surviving(a: np.ndarray, b: np.ndarray, short: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs (a, b) of rows of ``short`` are left after all steps."""
    left = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for at in range(0, _VALUES, STEP):
        now = short[a[left], at : at + STEP] == short[b[left], at : at + STEP]
        matches[left] += now.sum(axis=1)
        left = left[matches[left] >= least_matches(threshold, at + now.shape[1])]
    return left


def _binary(column: pa.Array, width: int, kind: str) -> np.ndarray:
    """A column of equally long binaries as rows of numbers."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(len(column), width)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, t_key (128 bits of the text), key (of its set; null without
    words), short (16 bits of each MinHash value), bands."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(2)):
                sets, begins = ngram_sets(data, offsets)
                n = len(offsets) - 1
                some = np.diff(begins) > 0
                values = signatures(sets, begins)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(some * BANDS))), pa.int32()), pa.array(band_hashes(values).ravel())
                )
                halves = iter(values.astype("<u2"))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, n),
                        batch.column(1).slice(row, n),
                        pa.array(set_keys(sets, begins), pa.binary()),
                        pa.array([next(halves).tobytes() if x else None for x in some], pa.binary()),
                        bands,
                    ],
                    ["doc_id", "t_key", "key", "short", "bands"],
                )

    text = text_of(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _text_key(text).alias("t_key"), text.alias("text")
    ).mapInArrow(of_batches, "doc_id long, t_key binary, key binary, short binary, bands array<long>")


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _packets(reps: DataFrame, threshold: float) -> DataFrame:
    """Surviving pairs, packed: packet, keys, rows (copies of each), pairs
    (little-endian 32-bit places in ``keys``, two for each pair)."""
    members = reps.select("key", F.posexplode("bands").alias("band", "bucket"))
    sizes = stored(
        members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "ngram-buckets"
    )
    met = attach_groups(members, sizes, ["bucket"], "size")
    chunks = F.ceil(F.col("size") / BLOCK)
    met = met.withColumn("chunk", F.pmod(F.xxhash64("key"), chunks).cast("int")).select(
        "key", "band", "bucket", "chunk", F.explode(F.sequence(F.lit(0), (chunks - 1).cast("int"))).alias("other")
    )
    blocks = met.select(
        "bucket", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "band", "chunk", "key"
    ).join(reps.select("key", "n", "short", "bands"), "key")
    blocks = blocks.select("bucket", "lo", "hi", "band", "chunk", "n", "key", "short", "bands")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        rest: pa.RecordBatch | None = None
        for batch in _with_end(batches):
            table = _joined(rest, batch)
            if table is None or not table.num_rows:
                continue
            heads = [table.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            new = np.concatenate(([True], np.any([h[1:] != h[:-1] for h in heads], axis=0)))
            starts = np.flatnonzero(new)
            stop = table.num_rows if batch is None else int(starts[-1])
            rest = table.slice(stop) if stop < table.num_rows else None
            for packet in _compared(table.slice(0, stop), starts[starts < stop], threshold):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([base + made], pa.int64()),
                        pa.array([packet[0]], pa.list_(pa.binary())),
                        pa.array([packet[1]], pa.list_(pa.int64())),
                        pa.array([packet[2]], pa.binary()),
                    ],
                    ["packet", "keys", "rows", "pairs"],
                )
                made += 1

    return (
        blocks.repartition("bucket", "lo", "hi")
        .sortWithinPartitions("bucket", "lo", "hi", "key")
        .mapInArrow(of_batches, "packet long, keys array<binary>, rows array<long>, pairs binary")
    )


def _with_end(batches):
    yield from batches
    yield None


def _joined(rest: pa.RecordBatch | None, batch: pa.RecordBatch | None) -> pa.RecordBatch | None:
    found = [x for x in (rest, batch) if x is not None]
    if len(found) < 2:
        return found[0] if found else None
    return pa.concat_batches(found)


def _compared(table: pa.RecordBatch, starts: np.ndarray, threshold: float) -> Iterator[tuple]:
    """Packets (keys, copies, packed pairs) of whole blocks."""
    n = table.num_rows
    if not n:
        return
    lo, hi, band, chunk, rows = (table.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4, 5))
    keys = np.array(table.column(6).to_pylist(), dtype=object)
    short = _binary(table.column(7), _VALUES, "<u2")
    bands = table.column(8).flatten().to_numpy().reshape(n, BANDS)
    stops = np.append(starts[1:], n)
    lengths = stops - starts
    block_of = np.repeat(np.arange(len(starts)), lengths)
    pairs = np.cumsum(lengths * (lengths - 1) // 2)
    at = 0
    while at < len(starts):
        done = pairs[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(pairs, done + PAIRS_AT_ONCE, "right")))
        a, b = [], []
        for g in range(at, end):
            if lengths[g] > 1:
                x, y = _upper(int(lengths[g]))
                a.append(x + starts[g])
                b.append(y + starts[g])
        at = end
        if not a:
            continue
        a, b = np.concatenate(a), np.concatenate(b)
        # Blocks of two chunks hold the pairs between them.
        fine = (lo[a] == hi[a]) | (chunk[a] != chunk[b])
        a, b = a[fine], b[fine]
        fine = np.argmax(bands[a] == bands[b], axis=1) == band[a]
        a, b = a[fine], b[fine]
        left = surviving(a, b, short, threshold)
        a, b = a[left], b[left]
        if not len(a):
            continue
        used = np.unique(np.concatenate((a, b)))
        blocks = block_of[used]
        packet_of = np.searchsorted(blocks, blocks, "left") // PACKET
        which = packet_of[np.searchsorted(used, a)]
        for p in np.unique(which):
            mine = which == p
            names = sorted(set(keys[a[mine]]) | set(keys[b[mine]]))
            place = {k: i for i, k in enumerate(names)}
            copies = {k: int(c) for side in (a, b) for k, c in zip(keys[side[mine]], rows[side[mine]], strict=True)}
            ends = np.array([[place[x], place[y]] for x, y in zip(keys[a[mine]], keys[b[mine]], strict=True)], "<i4")
            yield names, [copies[k] for k in names], ends.tobytes()


@lru_cache(maxsize=64)
def _upper(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _verified(docs: DataFrame, reps: DataFrame, packets: DataFrame, threshold: float, text_col: str, bits: int) -> DataFrame:
    """key, links (rows of the similar sets), root: one row per packet and
    member with a link."""
    places = packets.select("packet", F.posexplode("keys").alias("place", "key"))
    wanted = places.select("key").distinct().join(reps.select("key", "lead.t_key"), "key")
    members = stored(member_filter(wanted.select(F.xxhash64("t_key").alias("h")), "h", bits), "ngram-filter")
    text = text_of(text_col)
    texts = probe(docs.select(text.alias("text"), _text_key(text).alias("t_key")).withColumn("h", F.xxhash64("t_key")), "h", members, "maybe", bits)
    texts = texts.where("maybe").groupBy("t_key").agg(F.first("text").alias("text"))

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                sets, begins = ngram_sets(data, offsets)
                cells = [sets[a:b].astype("<u8").tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(set_keys(sets, begins), pa.binary()), pa.array(cells, pa.binary())], ["key", "cells"])

    sets = texts.select("text").mapInArrow(to_sets, "key binary, cells binary").groupBy("key").agg(F.first("cells").alias("cells"))
    nothing = F.lit(None)
    rows = places.join(sets, "key").select(
        "packet", "place", "key", "cells", nothing.cast("array<long>").alias("rows")
    ).unionByName(
        packets.select("packet", F.lit(-1).alias("place"), nothing.cast("binary").alias("key"), F.col("pairs").alias("cells"), "rows")
    )
    ratio = Fraction(str(threshold))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in _with_end(batches):
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch is not None else [(None,) * 5]
            for packet, place, key, cells, copies in rows:
                if held and packet != held["packet"]:
                    yield _links(held, ratio)
                    held = {}
                if packet is None:
                    continue
                if place < 0:
                    held = {"packet": packet, "pairs": np.frombuffer(cells, "<i4").reshape(-1, 2), "rows": copies, "keys": [], "sets": []}
                else:
                    held["keys"].append(key)
                    held["sets"].append(np.frombuffer(cells, "<u8"))

    return (
        rows.repartition("packet")
        .sortWithinPartitions("packet", "place")
        .mapInArrow(of_batches, "key binary, links long, root binary")
    )


def _links(held: dict, ratio: Fraction) -> pa.RecordBatch:
    """Exact similarities of a packet's pairs."""
    sets, keys = held["sets"], held["keys"]
    sizes = np.array([len(s) for s in sets])
    begins = np.cumsum([0, *sizes])
    _, cells = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(cells.max() + 1, bool)
    order = np.argsort(held["pairs"][:, 0], kind="stable")
    first, second = held["pairs"][order].T
    shared = np.zeros(len(first), np.int64)
    for a, start, stop in zip(*_runs(first), strict=True):
        marked[cells[begins[a] : begins[a + 1]]] = True
        for k in range(start, stop):
            b = second[k]
            shared[k] = np.count_nonzero(marked[cells[begins[b] : begins[b + 1]]])
        marked[cells[begins[a] : begins[a + 1]]] = False
    union = sizes[first] + sizes[second] - shared
    fine = shared * ratio.denominator >= union * ratio.numerator
    first, second = first[fine], second[fine]
    rows = np.array(held["rows"], np.int64)
    links = np.zeros(len(keys), np.int64)
    np.add.at(links, first, rows[second])
    np.add.at(links, second, rows[first])
    label = np.arange(len(keys))
    while True:
        new = label.copy()
        np.minimum.at(new, first, label[second])
        np.minimum.at(new, second, label[first])
        new = new[new]
        if (new == label).all():
            break
        label = new
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [pa.array([keys[k] for k in some], pa.binary()), pa.array(links[some]), pa.array([keys[label[k]] for k in some], pa.binary())],
        ["key", "links", "root"],
    )


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, start, stop) of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[starts], starts, np.append(starts[1:], len(values))


def classes(
    docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, t_key, class_id (smallest id among
    rows connected by similar texts), links (other rows at least as similar as
    the threshold), copies (rows of the same set, this one included),
    class_rows, lead (id and t_key of the row that stands for the class)."""
    if threshold < THRESHOLD:
        raise ValueError(f"the bands are made for a similarity of {THRESHOLD} or more, not {threshold}")
    ship(docs.sparkSession)
    seen = stored(sketches(docs, id_col, text_col), "ngram-sketches")
    lead = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t_key")
    reps = stored(
        seen.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min(lead).alias("lead"), F.count(F.lit(1)).alias("n"), F.first("short").alias("short"), F.first("bands").alias("bands")),
        "ngram-sets",
    )
    packets = stored(_packets(reps, threshold), "ngram-packets")
    found = stored(_verified(docs, reps, packets, threshold, text_col, bits), "ngram-links")
    labels = components(found.select(F.col("key").alias("u"), F.col("root").alias("v")))
    linked = (
        found.groupBy("key")
        .agg(F.sum("links").alias("links"))
        .join(labels.withColumnRenamed("node", "key"), "key")
        .join(reps.select("key", "lead", "n"), "key")
    )
    linked = stored(linked, "ngram-linked")
    groups = stored(
        linked.groupBy("label").agg(
            F.min("lead").alias("class_lead"), F.sum("n").alias("class_rows"), F.count(F.lit(1)).alias("sets")
        ),
        "ngram-classes",
    )
    placed = attach_groups(linked.select("key", "links", "label"), groups, ["label"], "sets").select(
        "key", "links", "class_lead", "class_rows"
    )
    per_set = stored(
        reps.select("key", "lead", "n")
        .join(placed, "key", "left")
        .select(
            "key",
            F.col("lead").alias("own"),
            "n",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("class_lead", "lead").alias("lead"),
            F.coalesce("class_rows", "n").alias("class_rows"),
        ),
        "ngram-per-set",
    )
    columns = ["doc_id", "t_key", F.col("lead.doc_id").alias("class_id"), "links", F.col("n").alias("copies"), "class_rows", "lead"]
    alone = per_set.where("n = 1").select(F.col("own.doc_id").alias("doc_id"), F.col("own.t_key").alias("t_key"), "links", "n", "class_rows", "lead")
    copies = attach_groups(seen.where("key IS NOT NULL").select("doc_id", "t_key", "key"), per_set.where("n > 1").drop("own"), ["key"], "n")
    empty = seen.where("key IS NULL").select(
        "doc_id", "t_key", F.lit(0).cast("long").alias("links"), F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("class_rows"), lead.alias("lead")
    )
    return alone.select(*columns).unionByName(copies.select(*columns)).unionByName(empty.select(*columns))


def join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, links, copies for every row."""
    return classes(docs, **options).select("doc_id", "class_id", "links", "copies")


def dedup_near(
    docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS
) -> DataFrame:
    """``docs`` with one row of each class: whole rows, the class's smallest
    id. Rows whose text is in no class of several stay in their tasks."""
    found = stored(
        classes(docs, threshold, id_col, text_col, bits).where("class_rows > 1").select("doc_id", "t_key", "lead"), "ngram-found"
    )
    same = F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("t_key") == F.col("lead.t_key"))
    gone = found.where(~same).select(F.col("doc_id").alias("g_id"), F.col("t_key").alias("g_key")).distinct()
    members = stored(member_filter(found.select(F.xxhash64("t_key").alias("h")), "h", bits), "ngram-in-classes")
    text = text_of(text_col)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        _text_key(text).alias("t_key"),
        text.rlike(WORD).alias("has_words"),
    ).withColumn("h", F.xxhash64("t_key"))
    # Rows without words are in no class of several: they never go that way.
    marked = probe(rows, "h", members, "maybe", bits).withColumn("maybe", F.col("maybe") & F.col("has_words"))
    one = marked.where("maybe").groupBy("t_key", "doc_id").agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("same"))
    kept = one.join(gone, (one.t_key == gone.g_key) & one.doc_id.eqNullSafe(gone.g_id), "left_anti")
    return marked.where("NOT maybe").select("row.*").unionByName(kept.select("row.*"))
