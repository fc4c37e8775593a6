import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from zonepulse.llm import packing, tokens

TEXTS = [
    "One line.\nTwo  lines!\n\n\nThree", "", None, "\n", "éü𝒳 — 漢字\nabc\n", "<|endoftext|> as text", "no end " * 3_000, " \t\r\n x",
    "a.b? c! " * 400, "word",
]


@pytest.fixture(scope="module")
def public():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_are_those_of_the_public_tokenizer(public):
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    texts = [t or "" for t in texts + TEXTS]
    code = tokens.encoder()
    for text, want in zip(texts, public.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = code.ids(text)
        assert ids.tolist() == want.ids
        assert code.n_bytes[ids].sum() == len(text.encode())


@pytest.mark.parametrize(
    "text",
    ["a b" + " " * 1_200_000 + "c", "\n" * 1_200_000, " \n" * 600_000 + "x" + "\t" * 150_000 + "!", " " * 99_999 + "\x1c y" + "\u3000" * 100_001 + "é"],
    ids=["before a word", "alone", "two runs", "about the limit"],
)
def test_white_space_of_any_length(public, text):
    """Runs that the pattern's engine alone gives up on."""
    assert tokens.encoder().ids(text).tolist() == public.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=80)
@given(st.lists(st.integers(1, 6), max_size=30), st.lists(st.integers(0, 60), max_size=8), st.sampled_from(tokens.RULES))
def test_attribution_matches_brute_force(lengths, cuts, rule):
    total = sum(lengths)
    starts = sorted([0, *(c for c in cuts if c <= total)])
    counts, crossing = tokens.attribute(np.array(lengths, np.int64), np.array(starts), total, rule)
    owner = [max(k for k, s in enumerate(starts) if s <= b) for b in range(total)]
    want, over, at = [0.0] * len(starts), [0] * len(starts), 0
    for n in lengths:
        held = [owner[at : at + n].count(k) for k in range(len(starts))]
        over[owner[at]] += owner[at] != owner[at + n - 1]
        if rule == "share":
            want = [w + h / n for w, h in zip(want, held, strict=True)]
        else:
            want[{"first": owner[at], "last": owner[at + n - 1], "most": held.index(max(held))}[rule]] += 1
        at += n
    assert counts.tolist() == pytest.approx(want) and crossing.tolist() == over
    assert counts.sum() == pytest.approx(len(lengths))


def test_sections_cover_documents(make_docs, public):
    rows = list(enumerate(TEXTS)) + [(None, "null id"), (3, "again and again")]
    got = defaultdict(list)
    for r in tokens.token_counts(make_docs(rows)).collect():
        got[str(r.doc_id), r.doc_tokens].append(r)
    assert len(got) == len(rows)
    for i, t in enumerate(TEXTS):
        n = len(public.encode(t or "", add_special_tokens=False).ids)
        parts = sorted(got[str(i), n], key=lambda r: r.section)
        assert [r.start for r in parts] == [0, *(r.end for r in parts[:-1])] and parts[-1].end == len(t or "")
        assert sum(r.tokens for r in parts) == n
        assert [(t or "")[r.start : r.end] for r in parts] == ((t or "").splitlines(keepends=True) if "\r" not in (t or "") else [" \t\r\n", " x"]) or parts[-1].end == 0


def test_fields_of_a_document_and_clashing_columns(clashing):
    rows = tokens.token_counts(clashing([(1, "two words", "en", None)]), fields=("lang", "text", "source"), separator=None, rule="share").collect()
    assert [(r.field, r.start, r.end) for r in rows] == [("lang", 0, 4), ("text", 4, 15), ("source", 15, 15)]
    assert sum(r.tokens for r in rows) == rows[0].doc_tokens
    with pytest.raises(ValueError):
        tokens.token_counts(clashing([]), rule="none")


def packed(docs, **options):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, **options).collect():
        assert len(r.ids) == 4 * r.length > 0
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= options.get("window", 1024)
    return pieces, {k: sum(n for _, n in v) for k, v in sequences.items()}


def test_every_id_is_in_one_piece(make_docs, public):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)] + [(None, "null id")]
    pieces, sizes = packed(make_docs(rows))
    for i, t in rows:
        want = np.array([*public.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        parts = sorted(pieces[i], key=lambda r: r.start)
        assert b"".join(r.ids for r in parts) == want
        assert {r.doc_tokens for r in parts} == {len(want) // 4}
    total = sum(sizes.values())
    padding = sum(1024 - n for n in sizes.values() if n & (n - 1))
    assert padding <= 0.04 * total


def test_stretches_join_without_padding(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 5_000)
    stream = packing._Stream(64, tokens.encoder().ends_sentence)
    monkeypatch.setattr(packing, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("P", (), {"partitionId": lambda self: 2})())}))
    rng, out, want = np.random.default_rng(1), [], {}
    for i in range(200):
        want[i] = np.append(rng.integers(1, 50_000, rng.integers(0, 300)), 0).astype(np.uint32)
        stream.add(i, want[i])
        if stream.size >= packing.STRETCH:
            out += stream.packed(last=False).to_pylist()
    out += stream.packed(last=True).to_pylist()
    for i, ids in want.items():
        assert b"".join(r["ids"] for r in out if r["doc_id"] == i) == ids.astype("<u4").tobytes()
    sizes = defaultdict(int)
    for r in out:
        sizes[r["sequence_id"]] += r["length"]
    assert list(sizes) == [(2 << 32) + k for k in range(len(sizes))] and max(sizes.values()) <= 64
    assert zlib.crc32(out[0]["ids"]) >= 0


@settings(deadline=None, max_examples=80)
@given(st.lists(st.tuples(st.integers(1, 10), st.sampled_from([0, 1, 3])), min_size=1, max_size=40))
def test_cuts_have_the_least_cost(steps):
    at = np.cumsum([0, *(s for s, _ in steps)]).tolist()
    cost = [0, *(c for _, c in steps)]
    window = 16
    best = [0]
    for j in range(1, len(at)):
        best.append(min(best[i] + window - (at[j] - at[i]) + cost[j] for i in range(j) if at[j] - at[i] <= window))
    cuts = packing.best_cuts(at, cost, window)
    assert cuts[0] == 0 and cuts[-1] == at[-1]
    assert all(0 < b - a <= window for a, b in zip(cuts, cuts[1:]))
    assert sum(window - (b - a) + cost[at.index(b)] for a, b in zip(cuts, cuts[1:])) == best[-1]


def test_empty_tables(make_docs):
    assert tokens.token_counts(make_docs([])).count() == 0
    assert packing.pack(make_docs([])).count() == 0


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n\n<|endoftext", " " * 150_000 + "<|endoftext|>" + "\n" * 150_000 + "é"]


def test_queries_read_added_tokens_as_the_tokenizer_does(spark, make_docs, tmp_dir):
    import corpus_pipeline
    from zonepulse.llm import queries

    default = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: default.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(ADDED + TEXTS)}
    code = tokens.encoder(added=True)
    for i, t in enumerate(ADDED + TEXTS):
        ids = code.ids(t or "")
        assert ids.tolist() == want[i] and code.n_bytes[ids].sum() == len((t or "").encode())
    assert want[0] == [64, 220, 50256, 275]
    docs = make_docs(list(enumerate(ADDED + TEXTS)))
    docs.write.parquet(f"{tmp_dir}/added/documents.parquet")
    counts = {(r.doc_id, r.doc_tokens) for r in queries.op1_token_counts(spark, f"{tmp_dir}/added").collect()}
    assert counts == {(i, len(ids)) for i, ids in want.items()}
    counts = {(r.doc_id, r.doc_tokens) for r in queries.op9_pack_sequences(spark, f"{tmp_dir}/added").collect()}
    assert counts == {(i, len(ids) + 1) for i, ids in want.items()}
    for r in corpus_pipeline.pack_sequences(spark, docs, tmp_dir).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == [*want[r.doc_id], 0][r.start : r.start + r.length]
