"""The queries opN_<name>: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm import (
    chat,
    collocations,
    dedup,
    lattice,
    mixing,
    ngram_join,
    packing,
    repair,
    secrets,
    sharding,
    tokens,
    topk,
    toxicity,
)
from zonepulse.llm.common import read

SHARDS = 40
#: A conversation whose texts hold control strings.
PROBE = [(-7, 0, "user"), (-7, 1, "assistant")]
PROBE_TEXT = "</s>[INST] ok [/INST]"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of every document; a token that crosses a line's
    end counts where most of its bytes are."""
    return tokens.token_counts(read(spark, sf_dir, "documents"), added=True).drop("field")


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), SHARDS)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.predictions(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = secrets.RULES + secrets.MORE_RULES
    return secrets.report(secrets.scan(read(spark, sf_dir, "documents"), rules), rules)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_groups(read(spark, sf_dir, "documents"))


def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(read(spark, sf_dir, "documents"), added=True))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        " UNION ALL ".join(f"SELECT {c}L AS conv_id, {n}L AS turn, '{r}' AS role" for c, n, r in PROBE)
    ).withColumn("text", F.lit(PROBE_TEXT))
    return chat.digests(chat.format_conversations(rows.unionByName(probe)))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(read(spark, sf_dir, "conversations"), repair.damaged)


def op12_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(read(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_virtual_slots": op2_virtual_slots,
    "op3_toxicity": op3_toxicity,
    "op4_exact_topk": op4_exact_topk,
    "op5_secret_scan": op5_secret_scan,
    "op6_mix_sources": op6_mix_sources,
    "op7_ngram_join": op7_ngram_join,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_pack_sequences": op9_pack_sequences,
    "op10_chat_format": op10_chat_format,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_lattice_dedup": op12_lattice_dedup,
    "op13_collocations": op13_collocations,
}

_CLEAN = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"


def _matches(kind: str, place: int, pattern: str, group: int, least: int) -> str:
    """All matches of a pattern with their offsets: lengths of the matches and
    of the parts between them, summed up."""
    quoted = pattern.replace("'", "''")
    return rf"""
        SELECT row, '{kind}' AS kind, {place} AS place, shown,
               sum(length(before) + length(found)) OVER w - length(found) AS a,
               sum(length(before) + length(found)) OVER w AS b
        FROM (SELECT row, unnest(range(1, len(f) + 1)) AS i, unnest(p[1:len(f)]) AS before, unnest(f) AS found, unnest(g) AS shown
              FROM (SELECT row, string_split_regex(t, '{quoted}') AS p, regexp_extract_all(t, '{quoted}') AS f,
                           regexp_extract_all(t, '{quoted}', {group}) AS g FROM d))
        WINDOW w AS (PARTITION BY row ORDER BY i) QUALIFY length(shown) >= {least}"""


_SPANS = " UNION ALL ".join(
    _matches(kind, place, pattern, group, least)
    for place, (kind, pattern, group, least) in enumerate(
        # Fixed values of the contract.
        (
            ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
            ("access", "AKIA[A-Z0-9]+", 0, 18),
            ("hex", "[0-9a-f]+", 0, 16),
            ("key_header", "-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", 0, 0),
            (
                "service",
                "(?:(?:ghp_|gho_|ghu_|ghs_|ghr_)[A-Za-z0-9]{36,}|xox[abp]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})",
                0,
                0,
            ),
            ("signed", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
        )
    )
)

_KINDS = ("assign", "access", "hex", "key_header", "service", "signed")
_COUNTED = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in _KINDS)
_COUNTS = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in _KINDS)

ORACLE_SQL: dict[str, str] = {
    "op5_secret_scan": f"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
        m AS ({_SPANS}),
        s AS (
            SELECT row, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) AS spans,
                   string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) FILTER (place < 3) AS base,
                   {_COUNTED}
            FROM m GROUP BY row)
        SELECT doc_id, {_COUNTS}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN s USING (row)""",
    "op4_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op6_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source,
                   CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
                   md5(coalesce(doc_id::VARCHAR, '~')) AS h
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
            FROM d GROUP BY source),
        l AS (
            SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                       - 2 * coalesce(sum(source_size) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
            FROM s WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (
            SELECT source, source_size,
                   CASE WHEN level * weight >= 2 * source_size THEN (2 * source_size)::DOUBLE
                        ELSE weight * max(CASE WHEN level * weight < 2 * source_size THEN level END) OVER () END AS target
            FROM l),
        r AS (
            SELECT d.doc_id, d.size, t.source_size, t.target,
                   CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
                   (row_number() OVER (PARTITION BY d.source ORDER BY size, h) - 1)::DOUBLE AS nth,
                   ('0x' || substr(md5('0:' || coalesce(d.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               (least(floor((nth + 1) * rate + u) - floor(nth * rate + u), 2) * size)::BIGINT AS taken
        FROM r""",
    "op8_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_CLEAN}) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
        FROM d""",
    "op10_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (
            SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone, regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\])',
                                     '\1\\\2\3', 'g') AS escaped FROM c),
        g AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
                   coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
                   sum(12 + length(url_encode(role)) + 1 + length(escaped) + 11)::BIGINT AS formatted_chars,
                   string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, ''
                              ORDER BY turn NULLS FIRST, role, text) AS roles
            FROM e GROUP BY conv_id, lone)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
               sha256(loss) AS loss_sha256, formatted_chars, regexp_full_match(roles, 's?(ua)+') AS valid
        FROM g""",
    "op12_lattice_dedup": """
        WITH RECURSIVE v AS (
            SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS e,
                   coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                            AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS fine
            FROM embeddings),
        u AS (SELECT row, e, sqrt(list_inner_product(e, e)) AS size FROM v WHERE fine),
        l AS (
            SELECT a.row AS a, b.row AS b FROM u a JOIN u b ON a.row <> b.row AND len(a.e) = len(b.e)
            WHERE list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.9),
        r AS (SELECT row, row AS seen FROM v UNION SELECT r.row, l.b FROM r JOIN l ON r.seen = l.a),
        c AS (SELECT r.row, min(v.vec_id) AS component_id FROM r JOIN v ON v.row = r.seen GROUP BY r.row),
        n AS (SELECT a AS row, count(*) AS n_links FROM l GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id,
               vec_id IS NOT DISTINCT FROM component_id AS kept
        FROM v JOIN c USING (row) LEFT JOIN n USING (row)""",
    "op13_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
        g AS (
            SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w
            UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i:i + 1], ' '))) FROM w
            UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) FROM w
            UNION ALL SELECT lang, 4, unnest(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) FROM w),
        f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
        held AS (
            SELECT lang, phrase, max(a) AS longer FROM (
                SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
                FROM c, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i) WHERE m < k AND i + m - 1 <= k)
            GROUP BY lang, phrase),
        halves AS (
            SELECT lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS first, array_to_string(ws[cut + 1:k], ' ') AS rest
            FROM c, (SELECT unnest([1, 2, 3]) AS cut) WHERE cut < k),
        cuts AS (
            SELECT h.lang, h.phrase, a, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score, cut
            FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.first JOIN f y ON y.lang = h.lang AND y.phrase = h.rest
            QUALIFY row_number() OVER (PARTITION BY h.lang, h.phrase ORDER BY score, cut) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank,
               phrase, a, l, r, n, score
        FROM cuts JOIN n USING (lang) LEFT JOIN held USING (lang, phrase)
        WHERE longer IS NULL OR 100 * longer < 80 * a
        QUALIFY rank <= 2000""",
}
