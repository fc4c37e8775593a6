"""Phrase collocations by top-order marginalisation.

Texts are cut into pieces at sentence and clause marks, pieces into words.
First, pieces are broken where no phrase of ``least`` occurrences can pass:
the word pairs of a task are counted by hash in ``bits`` counters, which travel
folded, a row for each block of counters, and a piece breaks between two words
whose counter stays below ``least``. What is left of the pieces is
mostly single words and common phrases, so a task hands on each different one
once, with its times. A phrase that occurs often has only pairs that do, so no
candidate's count changes, whatever the number of counters; full counters only
spare nothing. The counters that reach ``least`` are broadcast as ``bits`` bits.

Every word position of the broken pieces is the window of the word and the next
``LONGEST - 1`` words of its piece in columns of their own (lead columns, taken
inside the row, so no sort is needed), padded at the piece's end. Windows also
end before a triple whose counter stays below ``least``. Only these
longest windows are counted; Spark's ROLLUP over their columns sums them to the
counts of all shorter phrases, as each window's first k words are the
occurrence of a k-word phrase at its position. No explosion per n-gram length.

A candidate is scored at each of its cuts, floor(SCALE * a / (l + r)) in
decimals, and keeps the lowest; it is dropped where a longer
phrase that holds it occurs at least ``SHARE`` percent as often. Lookups of
parts go through ``attach_groups``, so a part that occurs in very many phrases
stays where it is. The last ranking runs in two steps, first inside salted
groups, of which each hands on ``top`` rows at most.

Defined cases: null texts are empty, a null lang is ``und``; texts or pieces
without words add nothing; white space inside a piece is space and tab, any
other character belongs to a word; repeated rows count each time; a text beyond
1 MB is worked on in stretches that end at marks; an empty
table gives an empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.llm.common import FILTER_BITS, attach_groups, member_filter, probe, ship, stored, text_of
from zonepulse.llm.hashing import LOWER, PIECE_BYTES, is_long, mixed, span_hashes, text_slices, word_bounds

#: Fixed values of the contract.
MARKS = r"[.,;:!?\x0A-\x0D]"
SPACE = r"[\x20\x09]+"
LONGEST = 4
LEAST = 30
SHARE = 80
SCALE = 2_000_000
TOP = 2000

#: What stands in a window after its last word; words are never empty.
PAD = ""
SALTS = 64
_W = [f"w{k}" for k in range(1, LONGEST + 1)]


_IS_MARK = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
_IN_WORD = ~_IS_MARK & ~np.isin(np.arange(256), [0x20, 0x09])
_COMBINE = np.uint64(0xD6E8FEB86659FD93)
#: Blocks that the counters of pairs are dealt in, at most.
BLOCKS = 1024
#: Pairs whose counters a task folds at once.
PAIRS_AT_ONCE = 1 << 22
#: Bytes of broken pieces that a task folds at once.
FOLD_BYTES = 1 << 25


def _rows(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))


def _stretches(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``text_slices``, of which none holds more of a long text than about
    ``PIECE_BYTES`` and the rest of the piece there."""
    for row, data, offsets in text_slices(texts):
        if not is_long(offsets):
            yield row, data, offsets
            continue
        ends = np.append(np.flatnonzero(_IS_MARK[data]) + 1, len(data))
        at = 0
        while at < len(data):
            stop = int(ends[min(np.searchsorted(ends, at + PIECE_BYTES), len(ends) - 1)])
            yield row, data[at:stop], np.array([0, stop - at])
            at = stop


def _lang_codes(langs: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(different langs, the place of each row's among them, its hash)."""
    coded = langs.dictionary_encode()
    places = coded.indices.to_numpy()
    names = [int.from_bytes(blake2b(x.encode(), digest_size=8).digest()) for x in coded.dictionary.to_pylist()]
    return coded.dictionary, places, np.array(names, np.uint64)[places]


def _pairs(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """(where words begin, where they end, their rows, whether the next word
    is in the same piece, the counter of both)."""
    starts, stops = word_bounds(data, offsets, _IN_WORD)
    words = span_hashes(data, starts, stops, LOWER)
    rows = np.searchsorted(offsets, starts, "right") - 1
    cuts = _IS_MARK[data]
    cuts[offsets[:-1][offsets[:-1] < len(data)]] = True
    piece = np.cumsum(cuts, dtype=np.int32)[starts]
    counters = mixed(words[:-1] * _COMBINE + words[1:] + langs[rows[:-1]]) % np.uint64(bits)
    return starts, stops, rows, piece[1:] == piece[:-1], counters


def _width(bits: int) -> int:
    """Counters in a block, whole bytes of bits."""
    return max(64, -(-bits // BLOCKS) + 7 & ~7)


def frequent_pairs(docs: DataFrame, least: int, bits: int = FILTER_BITS) -> np.ndarray:
    """The bits of the word pairs' counters that reach ``least``, as bytes:
    ``bits`` / 8 of them, whatever the input."""
    width = _width(bits)
    kind = "<u2" if width <= 1 << 16 else "<u4"

    def folded(held: list[np.ndarray]) -> pa.RecordBatch:
        places, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        blocks = np.unique(places // width)
        edges = np.append(np.searchsorted(places, blocks * width), len(places))
        within, counts = (places % width).astype(kind), counts.astype("<u4")
        parts = [[x[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)] for x in (within, counts)]
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks.astype(np.int32)), *(pa.array(x, pa.binary()) for x in parts)], ["block", "places", "counts"]
        )

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            _, _, langs = _lang_codes(batch.column(0))
            for row, data, offsets in _stretches(batch.column(1)):
                *_, near, counters = _pairs(data, offsets, langs[row:], bits)
                held.append(counters[near].astype(np.uint32 if bits <= 1 << 32 else np.uint64))
                size += len(held[-1])
                if size >= PAIRS_AT_ONCE:
                    yield folded(held)
                    size = 0
        if size:
            yield folded(held)

    def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            reached = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([reached], pa.binary())], ["block", "reached"])

        now, total = None, np.zeros(width, np.int64)
        for batch in batches:
            for block, places, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != now:
                    if now is not None and total.max() >= least:
                        yield done()
                    now = block
                    total[:] = 0
                total[np.frombuffer(places, kind)] += np.frombuffer(counts, "<u4")
        if now is not None and total.max() >= least:
            yield done()

    counted = (
        docs.mapInArrow(of_texts, "block int, places binary, counts binary")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(of_blocks, "block int, reached binary")
    )
    out = np.zeros((-(-bits // width), width // 8), np.uint8)
    for block, reached in counted.collect():
        out[block] = np.frombuffer(reached, np.uint8)
    return out.ravel()


def broken(docs: DataFrame, pairs: np.ndarray, bits: int = FILTER_BITS) -> DataFrame:
    """lang, text, times: the pieces, lower-cased and with single spaces, broken
    between two words whose bit isn't in ``pairs``; equal ones that a task
    folds at once are one row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(pairs)

    def folded(held: list[tuple[np.ndarray, ...]], names: pa.Array) -> pa.RecordBatch:
        text, sizes, owners = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        places = np.zeros(len(sizes) + 1, np.int32)  # no longer than the batch, whose offsets are such
        np.cumsum(sizes, out=places[1:])
        pieces = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(places), pa.py_buffer(text)).dictionary_encode()
        n = len(pieces.dictionary)
        keys, times = np.unique(owners.astype(np.int64) * n + pieces.indices.to_numpy(), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array(keys // n)), pieces.dictionary.take(pa.array(keys % n)), pa.array(times.astype(np.int64))],
            ["lang", "text", "times"],
        )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in batches:
            names, codes, langs = _lang_codes(batch.column(0))
            held: list[tuple[np.ndarray, ...]] = []
            size = 0
            for row, data, offsets in _stretches(batch.column(1)):
                starts, stops, rows, near, counters = _pairs(data, offsets, langs[row:], bits)
                if not len(starts):
                    continue
                marks = often[(counters >> np.uint64(3)).astype(np.int64)] >> (counters & np.uint64(7)).astype(np.uint8)
                on = np.append(near & (marks & 1 > 0), False)  # whether the next word stays with this one
                lengths = stops - starts + on
                ends = np.cumsum(lengths)
                # A word that the next one stays with takes along the white space behind it.
                text = LOWER[data[np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)]]
                text[ends[on] - 1] = 0x20
                last = np.flatnonzero(~on)
                held.append((text, np.diff(ends[last], prepend=0).astype(np.int32), codes[row:][rows[last]]))
                size += len(text)
                if size >= FOLD_BYTES:
                    yield folded(held, names)
                    size = 0
            if held:
                yield folded(held, names)

    return docs.mapInArrow(of_batches, "lang string, text string, times long")


def windows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", times: Column | None = None) -> DataFrame:
    """lang, w1 to w4, times (of the row; else 1) for every word position of
    every piece."""
    text = text_of(text_col)
    # Where every character is one byte, lower() changes A to Z alone.
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase)
    )
    pieces = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        (F.lit(1).cast("long") if times is None else times).alias("times"),
        F.explode(F.split(lowered, MARKS)).alias("piece"),
    )
    words = pieces.select("lang", "times", F.array_remove(F.split("piece", SPACE), "").alias("ws")).where(F.size("ws") > 0)
    ahead = [F.slice("ws", k, F.size("ws")).alias(w) for k, w in enumerate(_W, 1)]
    return words.select("lang", "times", F.inline(F.arrays_zip(*ahead))).select(
        "lang", *[F.coalesce(w, F.lit(PAD)).alias(w) for w in _W], "times"
    )


def frequent(found: DataFrame, words: int, least: int, bits: int = FILTER_BITS) -> DataFrame:
    """Membership filter of the phrases of so many words (each window's first)
    whose hash counter reaches ``least``."""
    counters = (
        found.where(F.col(_W[words - 1]) != PAD)
        .groupBy(_counter(_W[:words], bits).alias("h"))
        .agg(F.sum("times").alias("c"))
        .where(F.col("c") >= least)
    )
    return member_filter(counters.select("h"), "h", bits)


def _counter(words: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64("lang", *words), F.lit(bits))


def cut(found: DataFrame, phrases: DataFrame, words: int, starts: range, bits: int = FILTER_BITS) -> DataFrame:
    """The windows, padded from the end of the first phrase of so many words,
    beginning at one of ``starts``, that isn't in the filter."""
    for k in starts:
        hashed = found.withColumn("h", _counter(_W[k : k + words], bits))
        found = probe(hashed, "h", phrases, "often", bits)
        for w in _W[k + words - 1 :]:
            found = found.withColumn(w, F.when(F.col("often"), F.col(w)).otherwise(F.lit(PAD)))
        found = found.drop("h", "often")
    return found


def _joined(words: list[str]) -> Column:
    return F.concat_ws(" ", *words)


def phrase_counts(
    docs: DataFrame, least: int = LEAST, bits: int = FILTER_BITS, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """lang, k, phrase, f, w1 to w4: every phrase of up to four words that
    occurs ``least`` times (k from 1), and per lang its number of words (k 0)."""
    ship(docs.sparkSession)
    rows = _rows(docs, text_col, lang_col)
    pieces = stored(broken(rows, frequent_pairs(rows, least, bits), bits), "phrase-pieces")
    found = windows(pieces, times=F.col("times"))
    triples = stored(frequent(found, 3, least, bits), "phrase-triples")
    kept = cut(found, triples, 3, range(LONGEST - 2), bits)
    counted = stored(kept.groupBy("lang", *_W).agg(F.sum("times").alias("c")), "phrase-windows")
    # The longest phrases are counted already; ROLLUP sums their prefixes.
    *shorter, last = _W
    level = len(shorter) - sum(F.grouping(w).cast("int") for w in shorter)
    summed = (
        counted.rollup("lang", *shorter)
        .agg(F.sum("c").alias("f"), level.alias("k"), F.grouping("lang").alias("all_langs"))
        .where("all_langs = 0")
        .withColumn(last, F.lit(None).cast("string"))
    )
    longest = counted.select("lang", *_W, F.col("c").alias("f"), F.lit(LONGEST).alias("k"), F.lit(0).cast("tinyint").alias("all_langs"))
    summed = summed.unionByName(longest)
    whole = F.lit(True)
    for k, w in enumerate(_W, 1):
        whole = whole & ((F.col("k") < k) | (F.col(w) != PAD))
    fine = summed.where((F.col("k") == 0) | (whole & (F.col("f") >= least)))
    return fine.select("lang", "k", _joined(_W).alias("phrase"), "f", *_W)


def _parts(candidates: DataFrame) -> DataFrame:
    """lang, phrase, a, cut, side (0 before the cut, 1 after), part."""
    halves = []
    for k in range(2, LONGEST + 1):
        for cut in range(1, k):
            for side, words in enumerate((_W[:cut], _W[cut:k])):
                half = F.struct(F.lit(cut).alias("cut"), F.lit(side).alias("side"), _joined(words).alias("part"))
                halves.append(F.when(F.col("k") == k, half))
    return candidates.select("lang", "phrase", "a", F.explode(F.array_compact(F.array(*halves))).alias("x")).select(
        "lang", "phrase", "a", "x.*"
    )


def scored(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """lang, phrase, a with the counts of the lowest-scoring cut's sides
    (l, r) and its score; of equal scores the first cut."""
    parts = stored(_parts(candidates), "phrase-parts")
    uses = parts.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("uses"))
    known = phrases.select("lang", F.col("phrase").alias("part"), "f").join(uses, ["lang", "part"])
    met = attach_groups(parts, stored(known, "phrase-uses"), ["lang", "part"], "uses")
    sides = [F.max(F.when(F.col("side") == s, F.col("f"))).cast("decimal(19,0)") for s in (0, 1)]
    cuts = met.groupBy("lang", "phrase", "a", "cut").agg(sides[0].alias("l"), sides[1].alias("r"))
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div (l + r)")
    lowest = F.min(F.struct(score.alias("score"), "cut", F.col("l").cast("long").alias("l"), F.col("r").cast("long").alias("r")))
    return cuts.groupBy("lang", "phrase", "a").agg(lowest.alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")


def held_in_longer(candidates: DataFrame) -> DataFrame:
    """lang, phrase, longer: the highest count of a candidate that holds the
    phrase and is longer, for every phrase of two words or more so held."""
    spans = []
    for k in range(3, LONGEST + 1):
        inner = [_joined(_W[i : i + n]) for n in range(2, k) for i in range(k - n + 1)]
        spans.append(F.when(F.col("k") == k, F.array(*inner)))
    return (
        candidates.where("k > 2")
        .select("lang", F.explode(F.coalesce(*spans)).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE, bits: int = FILTER_BITS, **columns
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's ``top`` phrases of
    two to four words by score, then count, then phrase."""
    phrases = stored(phrase_counts(docs, least, bits, **columns), "phrase-counts")
    candidates = phrases.where("k > 1").withColumnRenamed("f", "a")
    wide = "CAST({} AS DECIMAL(3,0)) * CAST({} AS DECIMAL(19,0))"
    free = scored(candidates, phrases).join(held_in_longer(candidates), ["lang", "phrase"], "left").where(
        F.expr(f"longer IS NULL OR {wide.format(100, 'longer')} < {wide.format(share, 'a')}")
    )
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    salted = free.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    inside = Window.partitionBy("lang", "salt").orderBy(*order)
    first = salted.withColumn("rank", F.row_number().over(inside)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(
        F.col("rank") <= top
    )
    # At most top rows a lang meet one row a lang.
    words = phrases.where("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
