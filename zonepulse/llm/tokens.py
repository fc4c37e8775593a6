"""Tokens: the encoder that the token operators share, and token counts per
section by offset-mapped attribution.

A document is encoded once, as a whole. The vocabulary is byte-level, so the
lengths of its tokens in bytes give every token's span in the text; those
spans are joined with the spans of the sections (fields of the document, or
parts of them between separators) by binary search. A token that crosses a
boundary is allocated by an explicit rule:

first  to the section that holds its first byte
last   to the section that holds its last byte
most   to the section that holds most of its bytes, the earlier one if equal
share  to each section, the part of its bytes that the section holds

Sections cover the document without gaps (a separator ends its section), so
their counts add up to the document's.

Defined cases: null fields are empty; every document has at least one section,
an empty one counts 0 tokens; null or repeated ids are carried; other columns
are ignored; an empty table gives an empty result; texts of any length are
encoded whole; strings of special tokens are ordinary text, or with ``added``
the tokens that the vocabulary's JSON file lists for them, as its own tokenizer
reads them.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import ship

VOCABULARY = "byte_bpe_50k.tiktoken"
RULES = ("first", "last", "most", "share")
#: Runs of white space from this length on are encoded by themselves: the
#: pattern steps back through a run, and its engine gives up at about a million.
LONG_RUN = 100_000
#: White space as the pattern's engine has it.
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Tried at the begin of a run alone, so a search is linear.
_RUN = re.compile(rf"(?<!{_SPACE}){_SPACE}{{{LONG_RUN},}}")


def vocabulary_path(name: str) -> str:
    """A file of the installed public vocabularies; other paths as they are."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Byte-level BPE ids, equal to those of the same vocabulary elsewhere."""

    def __init__(self, name: str = VOCABULARY, added: bool = False):
        import public_tokenizers
        import tiktoken

        with open(vocabulary_path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._ranks = ranks
        self._encoding = tiktoken.Encoding(
            "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._added: dict[str, int] = {}
        if added:
            with open(vocabulary_path(name.removesuffix(".tiktoken") + ".json"), encoding="utf-8") as listed:
                for token in json.load(listed)["added_tokens"]:
                    if any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized")):
                        raise ValueError(f"added token {token['content']!r} is matched by more than its string")
                    self._added[token["content"]] = token["id"]
        longest = sorted(self._added, key=len, reverse=True)
        self._between = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        size = max([*ranks.values(), *self._added.values()]) + 1
        #: Bytes of each id, and whether a sentence or line ends with it.
        self.n_bytes = np.zeros(size, np.int64)
        self.ends_sentence = np.zeros(size, bool)
        for token, i in ranks.items():
            self.n_bytes[i] = len(token)
            self.ends_sentence[i] = token.rstrip()[-1:] in (b".", b"!", b"?") or b"\n" in token
        for token, i in self._added.items():
            self.n_bytes[i] = len(token.encode())

    @cached_property
    def _undivided(self):
        """The same vocabulary over a text as one piece."""
        import tiktoken

        return tiktoken.Encoding("piece", pat_str="(?s:.+)", mergeable_ranks=self._ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        out = []
        # Every other part is an added token.
        for k, part in enumerate(self._between.split(text) if self._between else (text,)):
            out += [self._added[part]] if k % 2 else self._ordinary(part)
        return np.array(out, dtype=np.uint32)

    def _ordinary(self, text: str) -> list[int]:
        out, at = [], 0
        for run in _RUN.finditer(text) if len(text) >= LONG_RUN else ():
            # The pattern makes a run one piece, but for its last character
            # if something follows, which begins the next piece.
            stop = run.end() - (run.end() < len(text))
            out += self._encoding.encode_ordinary(text[at : run.start()])
            out += self._undivided.encode_ordinary(text[run.start() : stop])
            at = stop
        return out + self._encoding.encode_ordinary(text[at:])


@lru_cache(maxsize=2)
def encoder(name: str = VOCABULARY, added: bool = False) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(name, added)


def section_starts(fields: list[bytes], separator: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of all sections in the joined fields, and their fields."""
    starts, owners, at = [], [], 0
    for k, field in enumerate(fields):
        starts.append(at)
        owners.append(k)
        if separator:
            i = field.find(separator)
            while i >= 0 and i + len(separator) < len(field):
                starts.append(at + i + len(separator))
                owners.append(k)
                i = field.find(separator, i + len(separator))
        at += len(field)
    return np.array(starts, np.int64), np.array(owners, np.int64)


def attribute(lengths: np.ndarray, starts: np.ndarray, total: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and tokens per section that cross into a later one.

    ``lengths``: bytes of each token in order; ``starts``: first byte of each
    section, ascending, the first 0; ``total``: bytes of the document.
    """
    ends = np.cumsum(lengths)
    begins = ends - lengths
    n = len(starts)
    # Of sections that start at the same byte all but the last are empty.
    first = np.searchsorted(starts, begins, "right") - 1
    last = np.searchsorted(starts, ends - 1, "right") - 1
    over = first != last
    crossing = np.bincount(first[over], minlength=n)
    if rule == "first":
        return np.bincount(first, minlength=n).astype(float), crossing
    if rule == "last":
        return np.bincount(last, minlength=n).astype(float), crossing
    counts = np.bincount(first[~over], minlength=n).astype(float)
    stops = np.append(starts[1:], total)
    for t in np.flatnonzero(over):
        inside = np.arange(first[t], last[t] + 1)
        held = np.minimum(stops[inside], ends[t]) - np.maximum(starts[inside], begins[t])
        if rule == "most":
            counts[inside[np.argmax(held)]] += 1
        else:
            counts[inside] += held / lengths[t]
    return counts, crossing


def token_counts(
    docs: DataFrame,
    fields: tuple[str, ...] = ("text",),
    joint: str = "\n\n",
    separator: str | None = "\n",
    rule: str = "most",
    id_col: str = "doc_id",
    vocabulary: str = VOCABULARY,
    added: bool = False,
) -> DataFrame:
    """One row per section: doc_id, field, section (from 0 in the document),
    start, end (code points in the joined document, end exclusive), tokens,
    crossing (tokens that begin here and end later), doc_tokens."""
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    ship(docs.sparkSession)
    names = list(fields)
    cut = separator.encode() if separator else None

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary, added)
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            ids = batch.column(0).to_pylist()
            columns = [batch.column(1 + k) for k in range(len(names))]
            for row, doc_id in enumerate(ids):
                parts = [(c[row].as_py() or "") + (joint if k + 1 < len(names) else "") for k, c in enumerate(columns)]
                encoded = [x.encode() for x in parts]
                starts, owners = section_starts(encoded, cut)
                whole = b"".join(encoded)
                lengths = code.n_bytes[code.ids("".join(parts))]
                counts, crossing = attribute(lengths, starts, len(whole), rule)
                # Code points before a byte: the bytes that begin a character.
                heads = np.concatenate(([0], np.cumsum((np.frombuffer(whole, np.uint8) & 0xC0) != 0x80)))
                n = len(starts)
                for values, more in zip(
                    out,
                    (
                        [doc_id] * n,
                        [names[k] for k in owners],
                        range(n),
                        heads[starts].tolist(),
                        heads[np.append(starts[1:], len(whole))].tolist(),
                        counts.tolist(),
                        crossing.tolist(),
                        [len(lengths)] * n,
                    ),
                    strict=True,
                ):
                    values.extend(more)
                if len(out[0]) >= 50_000:
                    yield _sections(out)
                    out = [[] for _ in range(8)]
            if out[0]:
                yield _sections(out)

    texts = [F.col(f"`{c}`").cast("string").alias(f"f{k}") for k, c in enumerate(names)]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), *texts).mapInArrow(
        of_batches,
        "doc_id long, field string, section int, start long, end long, tokens double, crossing long, doc_tokens long",
    )


def _sections(columns: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
    names = ("doc_id", "field", "section", "start", "end", "tokens", "crossing", "doc_tokens")
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], list(names))
