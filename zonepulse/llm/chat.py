"""Chat formatting, DataFrame operations only.

A declarative ``Template`` names the marks around a turn, the control strings
that no text may contain, the roles under the loss, and the allowed turn order
as transitions of a finite-state machine. The operator emits one row per
conversation: text segments, each with its loss flag, the joined string, the
spans of the loss in it, and whether the machine accepted the roles.

Control strings inside texts are escaped by one backslash after their first
character, before any backslashes that stand there already; taking one away
again restores the text, whatever it held. Role names stand URL-encoded in the
header.

Defined cases: rows go by turn, then role, then text, nulls first; a null
text or role is empty; a row with a null conv_id is a conversation of its own,
so they never gather in one task; every conversation is formatted, an invalid one is only marked; an empty table gives
an empty result; other columns are ignored. A conversation is one value of the
result, hence one row of one task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import prefix_sums


@dataclass(frozen=True)
class Template:
    turn_open: str = "<|im_start|>"
    header_end: str = "\n"
    turn_close: str = "<|im_end|>\n"
    #: Strings that mean something to a tokenizer or to this template.
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
    loss_roles: tuple[str, ...] = ("assistant",)
    #: (state, role) -> state; what is missing leads to ``reject``.
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    transitions: dict = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )


CHAT = Template()


def _groups(t: Template) -> tuple[str, str]:
    firsts = "".join(dict.fromkeys(re.escape(c[0]) for c in t.controls))
    rests = "|".join(re.escape(c[1:]) for c in t.controls)
    return firsts, rests


def escaped(text: Column, t: Template = CHAT) -> Column:
    firsts, rests = _groups(t)
    return F.regexp_replace(text, rf"([{firsts}])(\\*)({rests})", r"$1\\$2$3")


def unescaped(text: Column, t: Template = CHAT) -> Column:
    firsts, rests = _groups(t)
    return F.regexp_replace(text, rf"([{firsts}])\\(\\*)({rests})", "$1$2$3")


def state_after(roles: Column, t: Template = CHAT) -> Column:
    """The machine's state after all roles."""

    def step(state: Column, role: Column) -> Column:
        to = F.lit("reject")
        for (a, b), c in t.transitions.items():
            to = F.when((state == a) & (role == b), F.lit(c)).otherwise(to)
        return to

    return F.aggregate(roles, F.lit(t.start), step)


def format_conversations(rows: DataFrame, t: Template = CHAT) -> DataFrame:
    """conv_id, segments (text, loss), formatted, loss_spans (start, end in
    code points, end exclusive), valid."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    named = rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    turns = named.unionByName(rows.where(F.col("conv_id").isNull()).select("conv_id", F.array(turn).alias("turns")))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_turn(turn: Column) -> Column:
        return F.array(
            segment(F.concat(F.lit(t.turn_open), F.url_encode(turn["role"]), F.lit(t.header_end)), F.lit(False)),
            segment(escaped(turn["text"], t), turn["role"].isin(*t.loss_roles)),
            segment(F.lit(t.turn_close), F.lit(False)),
        )

    cut = turns.select(
        "conv_id",
        F.flatten(F.transform("turns", of_turn)).alias("segments"),
        state_after(F.transform("turns", lambda x: x["role"]), t).isin(*t.accept).alias("valid"),
    )
    ends = prefix_sums(F.transform("segments", lambda s: F.length(s["text"])))
    spans = F.transform(
        F.filter(F.arrays_zip(F.col("segments").alias("segment"), ends.alias("end")), lambda x: x["segment"]["loss"]),
        lambda x: F.struct((x["end"] - F.length(x["segment"]["text"])).alias("start"), x["end"].alias("end")),
    )
    return cut.select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        "valid",
    )


def read_back(formatted: Column, t: Template = CHAT) -> Column:
    """The turns (role, text) from a formatted string alone."""
    parts = F.split(formatted, re.escape(t.turn_open))
    bodies = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(body: Column) -> Column:
        header = F.substring_index(body, t.header_end, 1)
        begin = F.length(header) + len(t.header_end) + 1
        text = F.substring(body, begin, F.length(body) - begin + 1 - len(t.turn_close))
        return F.struct(F.url_decode(header).alias("role"), unescaped(text, t).alias("text"))

    return F.transform(bodies, turn)


def digests(formatted: DataFrame, t: Template = CHAT) -> DataFrame:
    """What the output says, read back from it."""
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], t)), "")
    read = formatted.select("conv_id", "formatted", "valid", read_back(F.col("formatted"), t).alias("turns"), loss.alias("loss"))
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
