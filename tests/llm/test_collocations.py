import random
import re
from collections import Counter

import pytest

from zonepulse.llm import collocations as C


def brute(rows, least, top, share=80):
    """Plain counts of every phrase of every length."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = []
    for lang in n:
        found = {p: a for (g, p), a in f.items() if g == lang and len(p) > 1 and a >= least}
        held = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i : i + k]] = max(held[p[i : i + k]], a)
        rows_of = []
        for p, a in found.items():
            if 100 * held[p] >= share * a:
                continue
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows_of.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus(seed, docs=60):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "É", "é", "x y", "a", "b", "\U0001f600", "c"]
    out = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randrange(1, 60)):
            if rng.random() < 0.4:
                parts.append(rng.choice(["new york city", "of the", "a b c a", "a a a a a", "é é"]))
            parts.append(rng.choice(words) + rng.choice([" ", "  ", "\t", ", ", ".", "!\n", "\r\n", " ; "]))
        out.append((" ".join(parts), rng.choice(["en", "de", None, "und", ""])))
    return out + [("", "en"), (None, "de"), (" \t .. ,\n", "fr"), ("one", "it"), ("same same", "en"), ("same same", "en")] * 3


@pytest.mark.parametrize("seed,least,top", [(1, 3, 2000), (2, 8, 5), (3, 30, 2000)])
def test_equals_plain_counts(spark, make_docs, seed, least, top):
    rows = corpus(seed)
    docs = make_docs([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)])
    found = C.collocations(docs, least=least, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, top)
    assert sorted(map(tuple, found.collect())) == want and (want or least == 30)


def test_counters_of_any_number_change_nothing(spark, make_docs):
    rows = corpus(4)
    docs = make_docs([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)])
    for bits in (64, 256):
        assert sorted(map(tuple, C.collocations(docs, 3, bits=bits).collect())) == brute(rows, 3, 2000)


def test_a_long_piece_and_hot_phrase(spark, make_docs):
    text = "very hot phrase " * 20_000
    rows = [(text, "en"), ("very hot", "en"), ("x " * 40, None)]
    docs = make_docs([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)])
    assert sorted(map(tuple, C.collocations(docs).collect())) == brute(rows, 30, 2000)


def test_counts_beyond_the_products_of_64_bits(spark):
    big = 9 * 10**18
    phrases = spark.createDataFrame(
        [("en", 1, "a", big, "a", None, None, None), ("en", 1, "b", big + 1, "b", None, None, None), ("en", 2, "a b", big, "a", "b", None, None)],
        "lang string, k int, phrase string, f long, w1 string, w2 string, w3 string, w4 string",
    )
    got = C.scored(phrases.where("k > 1").withColumnRenamed("f", "a"), phrases).collect()
    assert [tuple(r) for r in got] == [("en", "a b", big, big, big + 1, 2_000_000 * big // (2 * big + 1))]


def test_empty_table_and_clashing_columns(spark, make_docs, clashing):
    assert C.collocations(make_docs([])).collect() == []
    rows = corpus(5, 20)
    docs = clashing([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)])
    for c in ("w1", "w2", "k", "c", "f", "a", "piece", "phrase", "rank", "often", "_w", "_mask", "salt"):
        docs = docs.withColumn(c, docs["doc_id"])
    assert sorted(map(tuple, C.collocations(docs, 3).collect())) == brute(rows, 3, 2000)


def test_one_count_of_windows_and_a_rollup_instead_of_explosions(spark, make_docs):
    from tests.conftest import plan_text

    plan = plan_text(C.windows(make_docs([(1, "a b c")])))
    assert plan.count("Generate") >= 2 and "Exchange" not in plan.split("Generate")[0] and "Window" not in plan


def plain_pieces(rows, pairs):
    """Pieces broken between words that aren't in ``pairs`` (lang, a, b)."""
    out = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            run = []
            for word in re.findall(r"[^\x20\x09]+", piece):
                if run and (lang, run[-1], word) not in pairs:
                    out[lang, " ".join(run)] += 1
                    run = []
                run.append(word)
            if run:
                out[lang, " ".join(run)] += 1
    return out


@pytest.mark.parametrize("fold", [1, 1 << 25])
def test_pieces_break_at_rare_pairs_and_are_folded(spark, make_docs, monkeypatch, fold):
    """A task hands on each different rest of a piece once, not each word."""
    monkeypatch.setattr(C, "FOLD_BYTES", fold)
    rows = corpus(6) + [("Of  the\tOF THE", "en"), ("a" * 3000 + " é", "\U0001f600")]
    pairs = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text or ""):
            words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x20\x09]+", piece)]
            pairs.update(("und" if lang is None else lang, a, b) for a, b in zip(words, words[1:]))
    docs = C._rows(make_docs([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)], 1), "text", "lang")
    found = C.broken(docs, C.frequent_pairs(docs, 20)).collect()
    want = plain_pieces(rows, {p for p, n in pairs.items() if n >= 20})
    got = Counter()
    for r in found:
        got[r.lang, r.text] += r.times
    assert got == want and any(" " in t for _, t in want)
    assert fold == 1 or len(found) == len(want) < sum(want.values()) / 2


def test_all_counters_full_break_nothing(spark, make_docs):
    rows = [("a b, c d e", "en"), ("a  b", "en")]
    docs = C._rows(make_docs([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)], 1), "text", "lang")
    whole = C.np.full(1 << 23, 255, C.np.uint8)
    assert sorted(map(tuple, C.broken(docs, whole).collect())) == [("en", "a b", 2), ("en", "c d e", 1)]
    none = C.np.zeros(1 << 23, C.np.uint8)
    assert sorted(map(tuple, C.broken(docs, none).collect())) == [("en", x, 2 if x in "ab" else 1) for x in "abcde"]


def test_texts_beyond_a_stretch(spark, make_docs, monkeypatch):
    """Long texts are cut at marks alone; pairs are counted once, folded in
    several turns."""
    text = "new york city. " * 90_000 + "no mark here " * 100_000 + "new york"
    docs = make_docs([(1, text, "en", "s"), (2, "new york", "en", "s"), (3, None, None, "s")])
    texts = C.pa.array([text, "new york"])
    parts = [bytes(data) for _, data, _ in C._stretches(texts)]
    assert b"".join(parts) == (text + "new york").encode() and len(parts) > 2
    assert all(p.endswith(b".") for p in parts[:-2])
    monkeypatch.setattr(C, "PAIRS_AT_ONCE", 1000)
    rows = [(text, "en"), ("new york", "en"), (None, None)]
    assert sorted(map(tuple, C.collocations(docs).collect())) == brute(rows, 30, 2000)
