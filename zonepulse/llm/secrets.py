"""Secret scanning over a trigram inverted index, DataFrame operations only.

Each rule is a regular expression. ``trigram_query`` derives its Boolean query
from the parsed expression: an OR of ANDs of trigrams that every match holds.
The index holds, for the trigrams of all queries, posting lists of text hashes,
cut into blocks by hash so that no list outgrows a task. Queries intersect and
unite postings block by block; the hashes they leave are candidates, folded
into one filter of fixed size over (rule, hash), and the second scan verifies flagged
texts with the regex in place, so no text ever shuffles. A rule without
mandatory trigrams scans every text. A filter that fills up only sends more
texts to the regex.

Offsets are code points, end exclusive, from the lengths of matches and of the
parts between them. Defined cases: a null text is empty and has no spans; equal
texts share postings and each row is answered for itself; null or repeated ids
are just carried; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as node
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import FILTER_BITS, bound, member_filter, prefix_sums, probe, stored, text_of

#: Rows per block of the index, and blocks at least.
BLOCK_ROWS = 65_536
MIN_BLOCKS = 1_024
#: Alternatives that a derived query holds at most; beyond it gets weaker.
ALTERNATIVES = 64
#: Characters of a class that still counts as known text.
CLASS = 4


@dataclass(frozen=True)
class Rule:
    kind: str
    #: In the syntax that Java's and Python's expressions share.
    pattern: str
    #: Which group must have how many characters.
    group: int = 0
    least: int = 0


# Fixed values of the contract. Where a match is one run of a class, its least
# length stands in the pattern: a run that falls short has no other match in it.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Rules beside the base ones: headers of private keys, tokens of hosting, chat
#: and payment services, signed web tokens.
MORE_RULES = (
    Rule("key_header", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule(
        "service",
        r"(?:(?:ghp_|gho_|ghu_|ghs_|ghr_)[A-Za-z0-9]{36,}|xox[abp]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})",
    ),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

Query = set[frozenset[str]]
#: The query that every text answers.
ALL: Query = {frozenset()}


def _grams(word: str) -> frozenset[str]:
    return frozenset(word[i : i + 3] for i in range(len(word) - 2))


def _either(clauses) -> Query:
    """Without the clauses that another one implies."""
    found = set(clauses)
    return {c for c in found if not any(other < c for other in found)}


def _both(a: Query, b: Query) -> Query:
    """Where that would outgrow the limit, one side alone, the more telling:
    a weaker query that still holds for every match."""
    if len(a) * len(b) > ALTERNATIVES:
        return max(a, b, key=lambda q: min(map(len, q)))
    return _either(x | y for x in a for y in b)


def _of_class(members) -> set[str] | None:
    """The characters of a small class of ASCII characters, in lower case."""
    found: set[str] = set()
    for kind, value in members:
        low, high = value if kind is node.RANGE else (value, value)
        if kind not in (node.LITERAL, node.RANGE) or high > 127 or high - low >= 128:
            return None
        found |= {chr(c).lower() for c in range(low, high + 1)}
    return found if len(found) <= CLASS else None


def _item(kind, value) -> tuple[set[str] | None, Query]:
    """(all texts the item can match, if few and known; what a match needs)."""
    if kind is node.LITERAL:
        return ({chr(value).lower()} if value < 128 else None), ALL
    if kind is node.IN:
        return _of_class(value), ALL
    if kind is node.SUBPATTERN:
        return _sequence(value[3])
    if kind is node.ATOMIC_GROUP:
        return _sequence(value)
    if kind is node.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        if all(words is not None for words, _ in parts):
            return set().union(*[words for words, _ in parts]), ALL
        need = _either(c for words, query in parts for c in (query if words is None else map(_grams, words)))
        return None, need if len(need) <= ALTERNATIVES else ALL
    if kind in (node.MAX_REPEAT, node.MIN_REPEAT, node.POSSESSIVE_REPEAT):
        low, high, inner = value
        words, query = _sequence(inner)
        if low == 0:
            return (words | {""}, ALL) if high == 1 and words is not None else (None, ALL)
        return None, query if words is None else _either(map(_grams, words))
    if kind in (node.AT, node.ASSERT, node.ASSERT_NOT):
        return {""}, ALL
    return None, ALL


def _sequence(items) -> tuple[set[str] | None, Query]:
    words, query, known = {""}, ALL, True
    for kind, value in items:
        more, need = _item(kind, value)
        if more is not None and len(words) * len(more) <= ALTERNATIVES:
            words = {a + b for a, b in product(words, more)}
            continue
        # The known run ends here; a new one begins behind or with the item.
        query = _both(_both(query, _either(map(_grams, words))), need)
        words, known = {""} if more is None else more, False
    return (words, ALL) if known else (None, _both(query, _either(map(_grams, words))))


def trigram_query(rule: Rule) -> list[list[str]]:
    """OR of ANDs of lower-case trigrams that every match of the rule holds;
    empty if there are none, or if the expression can't be read here."""
    try:
        words, query = _sequence(_parser.parse(rule.pattern))
    except re.error:
        return []
    clauses = query if words is None else _either(map(_grams, words))
    return sorted(map(sorted, clauses)) if all(clauses) else []


def _text_hash() -> Column:
    return F.xxhash64(F.col("_text"))


def postings(texts: DataFrame, rules: tuple[Rule, ...], rows: int) -> DataFrame:
    """block, gram, hashes: the inverted index over the queries' trigrams."""
    grams = sorted({g for r in rules for clause in trigram_query(r) for g in clause})
    blocks = max(MIN_BLOCKS, -(-rows // BLOCK_ROWS))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    # The outer form: for the inner one Spark adds a filter that works the
    # array out a second time.
    return (
        texts.select(_text_hash().alias("h"), F.lower("_text").alias("low"))
        .select("h", F.explode_outer(found).alias("gram"))
        .where("gram IS NOT NULL")
        .groupBy(F.pmod(F.col("h"), F.lit(blocks)).alias("block"), "gram")
        .agg(F.collect_set("h").alias("hashes"))
    )


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """rule (its place in ``rules``), h: what the Boolean queries leave."""
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "hashes"))).alias("of"))
    none = F.array().cast("array<bigint>")

    def answer(rule: Rule) -> Column:
        every = [
            reduce(F.array_intersect, [F.coalesce(F.col("of")[g], none) for g in clause])
            for clause in trigram_query(rule)
        ]
        return reduce(F.array_union, every)

    asked = [(i, r) for i, r in enumerate(rules) if trigram_query(r)]
    return lists.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), answer(r).alias("hs")) for i, r in asked])).alias("x")
    ).select("x.rule", F.explode("x.hs").alias("h"))


def spans(text: Column, rule: Rule, place: int) -> Column:
    """Leftmost non-overlapping matches that pass, as (start, place, end)."""
    pattern = F.lit(rule.pattern)
    parts = F.struct(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("shown"),
        F.split(text, rule.pattern).alias("between"),
    )

    def passing(p: Column) -> Column:
        before = F.slice(p["between"], F.lit(1), F.size(p["found"]))
        ends = prefix_sums(F.zip_with(before, p["found"], lambda b, f: F.length(b) + F.length(f)))
        matches = F.arrays_zip(ends.alias("end"), p["found"].alias("found"), p["shown"].alias("shown"))
        return F.transform(
            F.filter(matches, lambda m: F.length(m["shown"]) >= rule.least),
            lambda m: F.struct(
                (m["end"] - F.length(m["found"])).alias("start"), F.lit(place).alias("place"), m["end"].alias("end")
            ),
        )

    return bound(parts, passing)


def scan(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = FILTER_BITS,
) -> DataFrame:
    """doc_id and ``spans``: all passing matches as (start, place of the rule
    in ``rules``, end), by start, then place."""
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    left = stored(candidates(postings(texts, rules, docs.count()), rules), "secret-candidates")
    members = stored(member_filter(left.select(F.xxhash64("h", "rule").alias("k")), "k", bits), "secret-filter")
    flagged = texts.withColumn("_h", _text_hash())
    none = F.array().cast("array<struct<start:int,place:int,end:int>>")
    found = []
    for i, rule in enumerate(rules):
        if trigram_query(rule):
            # The rules share one broadcast filter.
            flagged = probe(flagged.withColumn("_k", F.xxhash64("_h", F.lit(i))), "_k", members, f"_maybe{i}", bits)
            asked = F.col(f"_maybe{i}")
        else:
            asked = F.col("_text").rlike(rule.pattern)
        found.append(F.when(asked, spans(F.col("_text"), rule, i)).otherwise(none))
    return flagged.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def report(scanned: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(RULES)) -> DataFrame:
    """doc_id, n_<kind> for each rule, the digest of the joined spans of the
    first ``base`` rules and the joined spans of all."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def joined(found) -> Column:
        return F.array_join(
            F.transform(
                found,
                lambda s: F.concat_ws(":", F.element_at(kinds, s["place"] + 1), s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    places = F.transform("spans", lambda s: s["place"])
    counts = [
        F.size(F.filter(places, lambda p: p == F.lit(i))).cast("long").alias(f"n_{r.kind}") for i, r in enumerate(rules)
    ]
    of_base = joined(F.filter("spans", lambda s: s["place"] < base))
    return scanned.select(
        "doc_id", *counts, F.sha2(of_base.cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
