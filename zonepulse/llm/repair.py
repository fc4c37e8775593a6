"""Conversation structure repair by checkpointed dynamic programming.

A conversation's role initials must read ``(s?(ua)+)?``. Edits walk over its
rows: Keep (0), Rerole to user or assistant (1), Delete (2, required for blank
and duplicate rows), Insert an empty user or assistant turn anywhere (5); a
truncated row that stays adds 5. Costs of a row act on the four states of that
expression, so a run of rows is a 4 x 4 matrix of least costs.

Rows are ordered once, by a range partitioning that cuts a long conversation
between tasks, and numbered; ``BLOCK`` rows in a row form a block. Each block
gives its matrix; a walk backward over a conversation's blocks gives the cost
vector after each block, the checkpoints of the backward pass; blocks are then
recomputed from them on their own. Inside a block the same holds at square-root
spacing: vectors are kept at every isqrt(n)-th row, and the stretch between
two is recomputed while walking forward. The forward walk takes, of the edits
that keep the least cost, the ASCII-least one. It runs for each state a block
may start in; a walk over those exits gives the state it does start in.

Only the walks over blocks and the digests of ``report``, which hash a
conversation's text from its first to its last character, go row after row in
one task a conversation; both stream, holding one block or one batch.

Defined cases: nulls in role and text are one space; a null conv_id is a
conversation of its own; rows go by turn (nulls first), role, text; rows equal
in all of these are folded with a count, adjacent, the later ones duplicates of
the first; a row's first fault counts (blank, duplicate, truncated); a role
counts by its first character, other initials than s, u, a can't be kept;
very long texts are only matched and hashed; an empty table gives an empty
result; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import attach_groups, ship, stored

#: Fixed values of the contract.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
#: States: at the start, after the system turn, after a user's, after an
#: assistant's. What each may be followed by, and the state after it.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPT = (0, 3)
STATES = range(4)
INITIALS = "sua?"
LEGAL = ("su", "ua", "au")
#: Faults by number.
FINE, GONE, SHORT = 0, 1, 2
FAR = 1 << 60

BLOCK = 4096
_SPACE = r"\x20\x09-\x0D"


# --- the dynamic program -------------------------------------------------


def _closed(costs: list[int]) -> tuple[int, ...]:
    """Costs with Inserts allowed first: relaxed until nothing changes."""
    costs = list(costs)
    for _ in STATES:
        for state in STATES:
            for initial, to in NEXT[state].items():
                if initial in ROLES:
                    costs[state] = min(costs[state], INSERT + costs[to])
    return tuple(min(c, FAR) for c in costs)


FINISH = _closed([0 if s in ACCEPT else FAR for s in STATES])


def _choices(state: int, code: int, after: tuple[int, ...]) -> list[tuple[str, str, int, int]]:
    """(edit, what it makes, next state, cost up to the end) for one row, in
    ASCII order; ``k`` stands for the row's own role."""
    initial, fault = INITIALS[code // 3], code % 3
    found = [("D", "", state, DELETE + after[state])]
    if fault != GONE:
        stay = TRUNCATED if fault == SHORT else 0
        for kept, to in NEXT[state].items():
            if kept == initial:
                found.append(("K", "k", to, stay + after[to]))
        for role, to in NEXT[state].items():
            if role in ROLES:
                found.append(("R", role, to, REROLE + stay + after[to]))
    return found


@lru_cache(maxsize=1 << 16)
def _before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    return _closed([min(c[3] for c in _choices(s, code, after)) for s in STATES])


def before(code: int, times: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before ``times`` equal rows of a code, from those after them.
    Vectors are looked up less their minimum, so few ever differ."""
    least = min(after)
    now = _before(code, tuple(min(c - least, FAR) for c in after))
    more = least + DELETE * (times - 1)
    return tuple(min(c + more, FAR) for c in now)


@lru_cache(maxsize=1 << 16)
def _edit(state: int, code: int, after: tuple[int, ...]) -> tuple[str, str, int]:
    """(edits, what they make, next state) of the ASCII-least tight edits
    up to and with this row's own."""
    edits, made = "", ""
    while True:
        best = _before(code, after)[state]
        tight = [c[:3] for c in _choices(state, code, after) if c[3] == best]
        inserts = [
            ("I", role, to) for role, to in NEXT[state].items() if role in ROLES and INSERT + _before(code, after)[to] == best
        ]
        edit, make, state = min(tight + inserts)
        edits, made = edits + edit, made + make
        if edit != "I":
            return edits, made, state


def ending(state: int) -> str:
    """What is inserted after the last row."""
    made = ""
    while state not in ACCEPT:
        ((role, state),) = NEXT[state].items()
        made += role
    return made


def walk(codes: bytes, times: np.ndarray, after: tuple[int, ...], state: int) -> Iterator[tuple[str, str, int]]:
    """(edits, what they make, state after) of each row, from ``state`` on.
    Backward vectors are kept at square-root checkpoints only."""
    n = len(codes)
    step = isqrt(n) + 1
    marks, vector = {n: after}, after
    for i in reversed(range(n)):
        vector = before(codes[i], int(times[i]), vector)
        if i % step == 0:
            marks[i] = vector
    for start in range(0, n, step):
        stop = min(start + step, n)
        vectors = [marks[stop]]
        for i in reversed(range(start + 1, stop)):
            vectors.append(before(codes[i], int(times[i]), vectors[-1]))
        for i in range(start, stop):
            vector = vectors[stop - 1 - i]
            least = min(vector)
            edits, made, state = _edit(state, codes[i], tuple(min(c - least, FAR) for c in vector))
            yield edits + "D" * (int(times[i]) - 1), made, state


def matrix(codes: bytes, times: np.ndarray) -> list[int]:
    """Least costs from each state before the rows to each state after them."""
    columns = []
    for end in STATES:
        vector = _closed([0 if s == end else FAR for s in STATES])
        for i in reversed(range(len(codes))):
            vector = before(codes[i], int(times[i]), vector)
        columns.append(vector)
    return [columns[e][s] for s in STATES for e in STATES]


def through(costs: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(FAR, *(costs[4 * s + e] + after[e] for e in STATES)) for s in STATES)


# --- on Spark ------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the damage that crc32 of ``conv_id:turn`` picks."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    chance = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"]).cast("binary")) % 20
    text = (
        F.when(F.col("chance") == 1, F.lit(""))
        .when(F.col("chance") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    return (
        rows.select("conv_id", "turn", spaced["role"].alias("role"), spaced["text"].alias("text"), chance.alias("chance"))
        .where("chance != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("chance") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("chance") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def _matches(pattern: str) -> Column:
    return F.col("text").rlike(pattern)


def ordered(rows: DataFrame) -> DataFrame:
    """Folded rows in order: place (ascending over the table; consecutive
    within a conversation's part of a block), block, conv_id, turn, role,
    text, times, h (128 bits of conversation, role and text), initial (its
    number), blank, short."""
    read = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    keys = ["conv_id", "turn", "role", "text"]
    folded = read.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    placed = folded.repartitionByRange(_tasks(rows), *keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    same = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role").cast("string"), "role", "text")
    return placed.select(
        "place",
        F.floor(F.col("place") / F.lit(BLOCK)).cast("long").alias("block"),
        *keys,
        "times",
        F.unhex(F.md5(same.cast("binary"))).alias("h"),
        F.when(F.substring("role", 1, 1).isin(*INITIALS[:3]), F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1)
        .otherwise(3)
        .alias("initial"),
        (~_matches(f"[^{_SPACE}]")).alias("blank"),
        (~_matches(rf"[.!?][{_SPACE}]*\z")).alias("short"),
    )


_SEGMENT = (
    "conv_id long, block long, seg long, codes binary, times binary, matrix array<long>, "
    "blank long, duplicate long, truncated long, illegal long, first string, last string"
)

_SEGMENT_KINDS = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.list_(pa.int64())] + [pa.int64()] * 4 + [pa.string()] * 2


def segments(placed: DataFrame) -> DataFrame:
    """One row per block and conversation in it: its codes, matrix and faults."""
    groups = stored(
        placed.groupBy("h").agg(F.min("place").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1"), "repair-repeated"
    )
    later = attach_groups(placed.select("h", "place"), groups, ["h"], "size").where("place > head").select(
        "place", F.lit(True).alias("later")
    )
    codes = placed.select("block", "place", "conv_id", "initial", "blank", "short", "times").join(later, "place", "left")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None
        for batch in batches:
            done = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:2] != key:
                    done.append(_segment(key, held))
                    held = []
                key = row[:2]
                held.append(row[2:])
            yield _table(done, _SEGMENT, _SEGMENT_KINDS)
        if held:
            yield _table([_segment(key, held)], _SEGMENT, _SEGMENT_KINDS)

    return (
        codes.select("conv_id", "block", "place", "initial", "blank", "short", F.coalesce("later", F.lit(False)).alias("later"), "times")
        # A fixed number of tasks: rows are slim, the work on them is not.
        .repartition(_tasks(placed), "block")
        .sortWithinPartitions("block", "place")
        .mapInArrow(of_batches, _SEGMENT)
    )


def _tasks(rows: DataFrame) -> int:
    return max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _table(rows: list[tuple], schema: str, kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in schema.split(", ")]
    )


def _segment(key: tuple, rows: list[tuple]) -> tuple:
    codes, faults, illegal = bytearray(), [0, 0, 0], 0
    text = "".join(INITIALS[r[1]] for r in rows)
    for _, initial, blank, short, later, times in rows:
        fault = GONE if blank or later else SHORT if short else FINE
        codes.append(initial * 3 + fault)
        faults[0] += times if blank else 0
        faults[1] += 0 if blank else times if later else times - 1
        faults[2] += fault == SHORT
        illegal += times - 1
    illegal += sum(text[i : i + 2] not in LEGAL for i in range(len(text) - 1))
    times = np.array([r[5] for r in rows], "<i8")
    return (*key, rows[0][0], bytes(codes), times.tobytes(), matrix(bytes(codes), times), *faults, illegal, text[0], text[-1])


def _by_conversation(rows: DataFrame, order: Column) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", order)


def _vectors(segs: DataFrame) -> DataFrame:
    """seg, after (costs after it), last: the checkpoints, from the end on."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, vector = ..., FINISH
        for batch in batches:
            segs, afters, lasts = [], [], []
            for conv, _, seg, costs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lasts.append(conv != now)
                vector = FINISH if conv != now else vector
                now = conv
                segs.append(seg)
                afters.append(list(vector))
                vector = through(costs, vector)
            yield pa.RecordBatch.from_arrays(
                [pa.array(segs, pa.int64()), pa.array(afters, pa.list_(pa.int64())), pa.array(lasts, pa.bool_())], ["seg", "after", "last"]
            )

    return _by_conversation(segs.select("conv_id", "block", "seg", "matrix"), F.col("block").desc()).mapInArrow(
        of_batches, "seg long, after array<long>, last boolean"
    )


def _exits(segs: DataFrame) -> DataFrame:
    """conv_id, block, seg, exits (the state after it for each before it),
    first, tail (initials of its first and last row)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exits = []
            for codes, times, after in zip(*(batch.column(k).to_pylist() for k in (3, 4, 5)), strict=True):
                times, out = np.frombuffer(times, "<i8"), []
                for state in STATES:
                    for _, _, state in walk(codes, times, tuple(after), state):
                        pass
                    out.append(state)
                exits.append(out)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in (0, 1, 2)), pa.array(exits, pa.list_(pa.int64())), batch.column(6), batch.column(7)],
                ["conv_id", "block", "seg", "exits", "first", "tail"],
            )

    return segs.select("conv_id", "block", "seg", "codes", "times", "after", "first", F.col("last").alias("tail")).mapInArrow(
        of_batches, "conv_id long, block long, seg long, exits array<long>, first string, tail string"
    )


def _entries(exits: DataFrame) -> DataFrame:
    """seg, entry (the state before it), border (1 where its first row and
    the row before it are not a legal pair)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, tail = ..., 0, ""
        for batch in batches:
            segs, entries, borders = [], [], []
            for conv, _, seg, out, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != now:
                    now, state, tail = conv, 0, ""
                segs.append(seg)
                entries.append(state)
                borders.append(int(bool(tail) and tail + first not in LEGAL))
                state, tail = out[state], last
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (segs, entries, borders)], ["seg", "entry", "border"])

    return _by_conversation(exits, F.col("block")).mapInArrow(of_batches, "seg long, entry long, border long")


_EDIT = "place long, edits string, made string, tail string"
_EDIT_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string()]


def _edits(segs: DataFrame) -> DataFrame:
    """place, edits, made, tail (inserted after the conversation's last row)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done: list[tuple] = []
            for seg, codes, times, after, last, state in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place = seg
                for edits, made, state in walk(codes, np.frombuffer(times, "<i8"), tuple(after), state):
                    done.append((place, edits, made, ""))
                    place += 1
                if last:
                    done[-1] = (*done[-1][:3], ending(state))
                if len(done) >= BLOCK:
                    yield _table(done, _EDIT, _EDIT_KINDS)
                    done = []
            yield _table(done, _EDIT, _EDIT_KINDS)

    return segs.select("seg", "codes", "times", "after", "is_last", "entry").mapInArrow(
        of_batches, _EDIT
    )


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired, faults). repaired, a row per distinct row in order: conv_id,
    place, turn, role, text, times, edits (its letters, those of Inserts
    before it and of its copies with it), turns (role and text of what
    stands in its place), cost. faults, a row per conversation that has
    rows: conv_id, blank, duplicate, truncated, illegal."""
    ship(rows.sparkSession)
    placed = stored(ordered(rows), "repair-rows")
    cut = stored(segments(placed), "repair-segments")
    checkpoints = stored(_vectors(cut).withColumnRenamed("last", "is_last"), "repair-checkpoints")
    with_after = cut.join(checkpoints, "seg")
    entries = stored(_entries(_exits(with_after)), "repair-entries")
    edits = _edits(with_after.join(entries, "seg"))
    placed = placed.join(edits, "place")
    # The row's own edit, after Inserts and before the Deletes of its copies.
    own = F.substring_index(F.regexp_replace("edits", "D+$", ""), "I", -1)
    letters = F.concat("edits", F.repeat(F.lit("I"), F.length("tail")))
    cost = sum(weight * (F.length(letters) - F.length(F.replace(letters, F.lit(x), F.lit("")))) for x, weight in (("R", REROLE), ("D", DELETE), ("I", INSERT)))
    kept_short = F.when(F.col("short") & (own != ""), TRUNCATED).otherwise(0)
    repaired = placed.select(
        "conv_id",
        "place",
        "turn",
        "role",
        "text",
        "times",
        letters.alias("edits"),
        F.concat(_turns("made", own != ""), _turns("tail", F.lit(False))).alias("turns"),
        (cost + kept_short).cast("long").alias("cost"),
    )
    faults = (
        cut.join(entries, "seg")
        .groupBy("conv_id")
        .agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.sum(F.col("illegal") + F.col("border")).alias("illegal"))
    )
    return stored(repaired, "repair-turns"), faults


def _turns(made: str, own: Column) -> Column:
    """(role, text) for each letter of ``made``; the last is the row itself
    where ``own``, the others were inserted."""
    letters = F.array_remove(F.split(made, ""), "")

    def one(letter: Column, at: Column) -> Column:
        mine = own & (at == F.size(letters) - 1)
        name = F.when(letter == "u", F.lit(ROLES["u"])).when(letter == "a", F.lit(ROLES["a"])).otherwise(F.col("role"))
        return F.struct(name.alias("role"), F.when(mine, F.col("text")).otherwise(F.lit("")).alias("text"))

    return F.transform(letters, one)


_DIGEST = "conv_id long, audit string, repaired_sha256 string"
_DIGEST_KINDS = [pa.int64(), pa.string(), pa.string()]


def _digests(repaired: DataFrame) -> DataFrame:
    """conv_id, audit, repaired_sha256: each conversation read once from its
    first to its last row, hashed on the way."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, digest, begun = ..., [], hashlib.sha256(), False
        for batch in batches:
            done = []
            for conv, _, edits, turns in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != now:
                    if now is not ...:
                        done.append((now, "".join(audit), digest.hexdigest()))
                    now, audit, digest, begun = conv, [], hashlib.sha256(), False
                audit.append(edits)
                for turn in turns:
                    digest.update(f"{chr(10) * begun}{turn['role']}:{turn['text']}".encode())
                    begun = True
            yield _table(done, _DIGEST, _DIGEST_KINDS)
        if now is not ...:
            yield _table([(now, "".join(audit), digest.hexdigest())], _DIGEST, _DIGEST_KINDS)

    return _by_conversation(repaired.select("conv_id", "place", "edits", "turns"), F.col("place")).mapInArrow(
        of_batches, _DIGEST
    )


def report(rows: DataFrame, damage=None) -> DataFrame:
    """One row per conversation of ``rows``, repaired after ``damage``: gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    repaired, faults = repair(damage(rows) if damage else rows)
    turn = F.col("turn")
    sums = repaired.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.countDistinct(turn), F.lit(0)).cast("long").alias("gaps"),
        F.sum("cost").alias("cost"),
    )
    out = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for more in (sums, faults, _digests(repaired)):
        more = more.withColumnRenamed("conv_id", "c_id")
        out = out.join(more, F.col("conv_id").eqNullSafe(F.col("c_id")), "left").drop("c_id")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
