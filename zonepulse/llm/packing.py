"""Packing into sequences by order-preserving dynamic programming.

Each task takes its documents in their order as one stream of token ids, every
document followed by id 0, and chooses cuts. A cut at a document's end is
free, one at a sentence's end costs ``SENTENCE`` tokens, one inside a sentence
(offered only in long ones) ``INSIDE``; what a sequence lacks to the window is
its padding. The sum of both is least under

    best(j) = min over i, b(j) - b(i) <= window, of
              best(i) + window - (b(j) - b(i)) + penalty(j)

whose minimum over the sliding range comes from a monotone queue, so a stretch
of n cut points takes O(n). The stream is worked off in stretches of
``STRETCH`` tokens; the last two sequences of a stretch go back into the next,
so memory is bounded and nothing is padded between stretches. Only the last
sequence of a task could be short: it is cut into lengths that are powers of
two, which need no padding.

Nothing shuffles and no id crosses tasks. Sequence ids hold the task's
partition number above bit 32. Defined cases: a null text is empty and is
its id 0 alone; null or repeated ids are carried; other columns are ignored; a
document longer than a window becomes several pieces; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import ship
from zonepulse.llm.tokens import VOCABULARY, encoder

WINDOW = 1024
END_ID = 0
#: Costs of a cut, in tokens of padding.
SENTENCE = 4
INSIDE = 12
#: Sentences longer than this also offer cuts inside, so many tokens apart.
LONG = 32
STRETCH = 1 << 18


def cut_points(
    ids: np.ndarray, ends: np.ndarray, ends_sentence: np.ndarray, apart: int = LONG
) -> tuple[np.ndarray, np.ndarray]:
    """Where the stream may be cut, from 0 to its length, and what it costs.
    ``ends``: ends of documents, the last may lie beyond the stream."""
    total = len(ids)
    cost = np.full(total + 1, -1, np.int64)
    cost[1:][ends_sentence[ids]] = SENTENCE
    cost[ends[ends <= total]] = 0
    cost[0] = cost[total] = 0
    at = np.flatnonzero(cost >= 0)
    gaps = np.diff(at)
    for k in np.flatnonzero(gaps > apart):
        inside = np.arange(at[k] + apart, at[k + 1], apart)
        cost[inside] = INSIDE
    at = np.flatnonzero(cost >= 0)
    return at, cost[at]


def best_cuts(at: list[int], cost: list[int], window: int = WINDOW) -> list[int]:
    """The chosen cut points, first and last included. No two neighbours in
    ``at`` may be more than ``window`` apart."""
    n = len(at)
    back = [0] * n
    queue, values, head = [0], [at[0]], 0  # ascending values best(i) + b(i)
    for j in range(1, n):
        low = at[j] - window
        while at[queue[head]] < low:
            head += 1
        back[j] = queue[head]
        value = values[head] + window + cost[j]
        while len(values) > head and values[-1] > value:
            values.pop()
            queue.pop()
        queue.append(j)
        values.append(value)
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return [at[j] for j in reversed(cuts)]


def powers(length: int) -> list[int]:
    """Descending powers of two that add up to ``length``."""
    return [1 << k for k in reversed(range(length.bit_length())) if length >> k & 1]


class _Stream:
    """The documents of a task that aren't packed yet."""

    def __init__(self, window: int, ends_sentence: np.ndarray):
        self.window, self.ends_sentence = window, ends_sentence
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple] = []  # (doc_id, tokens of the document, tokens before this part)
        self.size = 0
        self.sequences = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids), 0))
        self.parts.append(ids)
        self.size += len(ids)

    def packed(self, last: bool) -> pa.RecordBatch | None:
        ids = np.concatenate(self.parts)
        begins = np.cumsum([0, *map(len, self.parts)])
        at, cost = cut_points(ids, begins[1:], self.ends_sentence, min(LONG, self.window))
        cuts = best_cuts(at.tolist(), cost.tolist(), self.window)
        if last:
            short = cuts[-1] - cuts[-2]
            if short < self.window:
                cuts[-1:] = (cuts[-2] + np.cumsum(powers(short))).tolist()
        else:
            cuts = cuts[:-2]
        if len(cuts) < 2:
            return None
        stop = cuts[-1]
        cuts = np.array(cuts)
        edges = np.union1d(cuts, begins[begins < stop])
        starts, lengths = edges[:-1], np.diff(edges)
        doc = np.searchsorted(begins, starts, "right") - 1
        sequence = np.searchsorted(cuts, starts, "right") - 1
        base = TaskContext.get().partitionId() << 32
        owners = [self.docs[k] for k in doc]
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([o[0] for o in owners], pa.int64()),
                pa.array(starts - begins[doc] + np.array([o[2] for o in owners], np.int64)),
                pa.array(lengths.astype(np.int64)),
                pa.array([ids[a : a + n].astype("<u4").tobytes() for a, n in zip(starts, lengths, strict=True)], pa.binary()),
                pa.array([o[1] for o in owners], pa.int64()),
                pa.array(sequence.astype(np.int64) + base + self.sequences),
                pa.array((starts - cuts[sequence]).astype(np.int64)),
            ],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )
        self.sequences += len(cuts) - 1
        k = int(np.searchsorted(begins, stop, "right")) - 1
        rest = [(d, n, before) for d, n, before in self.docs[k:]]
        parts = self.parts[k:]
        if rest and stop > begins[k]:
            cut = int(stop - begins[k])
            rest[0] = (rest[0][0], rest[0][1], rest[0][2] + cut)
            parts[0] = parts[0][cut:]
        self.docs, self.parts, self.size = rest, parts, int(begins[-1] - stop)
        return out


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    added: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned
    32-bit numbers), doc_tokens, sequence_id, offset in the sequence. With
    ``added``, strings of the vocabulary's added tokens are those tokens."""

    ship(docs.sparkSession)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary, added)
        stream = _Stream(window, code.ends_sentence)
        end = np.array([END_ID], np.uint32)
        for batch in batches:
            texts = batch.column(1)
            for row, doc_id in enumerate(batch.column(0).to_pylist()):
                stream.add(doc_id, np.concatenate((code.ids(texts[row].as_py() or ""), end)))
                if stream.size >= STRETCH and (out := stream.packed(last=False)) is not None:
                    yield out
        if stream.size and (out := stream.packed(last=True)) is not None:
            yield out

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        of_batches,
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
