import re
from collections import defaultdict

import numpy as np
import pytest
from zonepulse.llm import components, hashing, ngram_join


def sets_of(rows):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        out.append((i, t or "", frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()))
    return out


def brute(rows):
    """(id, class_id, links, copies) of every row, and the rows that stay."""
    found = sets_of(rows)
    parent = list(range(len(found)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links, copies = [0] * len(found), [0] * len(found)
    for a, (_, _, s) in enumerate(found):
        for b, (_, _, t) in enumerate(found):
            if a == b:
                copies[a] += 1
            elif s and t and 5 * len(s & t) >= 4 * len(s | t):
                links[a] += 1
                copies[a] += s == t
                parent[root(a)] = root(b)
    members = defaultdict(list)
    for a, (i, *_) in enumerate(found):
        members[root(a)].append(i)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    out = sorted(((found[a][0], least(members[root(a)]), links[a], copies[a]) for a in range(len(found))), key=str)
    return out, sorted((least(m) for m in members.values()), key=str)


def near_copies(n, base_words=60, groups=4, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = [f"w{g}x{k}" for k in range(base_words)]
        for _ in range(n):
            t = list(base)
            for k in rng.integers(0, base_words, rng.integers(0, 4)):
                t[k] = f"r{rng.integers(1e9)}"
            rows.append((len(rows), " ".join(t)))
    return rows


EDGES = [
    (1_000, None), (1_001, ""), (1_002, " \n"), (1_003, "four words are here"), (1_004, "four  words are\there"), (1_005, "Four words are here"),
    (1_006, "one"), (None, "w0x0 alone and without any id at all"), (1_007, "a b c d e"), (1_008, "a b c d e f"), (1_009, "z " * 5_000),
    (1_010, "z " * 9_000), (1_011, "w " * 10), (1_011, "w " * 10),
]


@pytest.mark.parametrize("block", [256, 8])
def test_join_matches_brute_force(make_docs, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(25) + EDGES
    got = sorted((tuple(r) for r in ngram_join.join(make_docs(rows)).collect()), key=str)
    assert got == brute(rows)[0]


def test_one_row_of_each_class_stays(clashing):
    rows = near_copies(6) + EDGES
    docs = clashing(rows)
    kept = ngram_join.dedup_near(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == brute(rows)[1]


def test_a_full_filter_changes_nothing(make_docs):
    rows = near_copies(5) + EDGES
    assert sorted((r.doc_id for r in ngram_join.dedup_near(make_docs(rows), bits=64).collect()), key=str) == brute(rows)[1]


@pytest.mark.parametrize("bits", [1 << 26, 64])
def test_rows_without_words_stay_however_full_the_filter(make_docs, bits):
    rows = [(5, "")] * 3 + [(6, None)] * 2 + [(100 + i // 2, f"five words in every text {i // 2}") for i in range(80)]
    kept = ngram_join.dedup_near(make_docs(rows), bits=bits).collect()
    assert sorted(r.doc_id for r in kept) == [5] * 3 + [6] * 2 + list(range(100, 140))


def test_a_threshold_below_the_bands_is_refused(make_docs):
    with pytest.raises(ValueError):
        ngram_join.join(make_docs(EDGES), threshold=0.5)


def test_pruning_follows_the_posterior():
    from math import comb

    for n in (16, 48, 96):
        m = ngram_join.least_matches(0.8, n)
        part = lambda k: sum(comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(k + 1))  # noqa: E731,B023
        assert part(m) >= ngram_join.TOLERANCE and (m == 0 or part(m - 1) < ngram_join.TOLERANCE)


def test_components_of_a_path_a_hub_and_a_loop(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(200, 201), (201, 202), (202, 200), (200, 201)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(60)}, 200: 200, 201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_table(make_docs):
    assert ngram_join.join(make_docs([])).count() == 0
    assert ngram_join.dedup_near(make_docs([])).count() == 0


def test_pieces_of_a_long_text_change_nothing(monkeypatch):
    texts = ["", " \n", "one", "a b c d", "a b c d e", "a  b\tc d e f", "z " * 300, " ".join(f"w{k % 70}" for k in range(400)), "y" * 900, "q " + "y" * 900]

    def made():
        for t in texts:
            data = np.frombuffer(t.encode(), np.uint8)
            sets, begins = ngram_join.ngram_sets(data, np.array([0, len(data)]))
            yield sets.tolist(), ngram_join.set_keys(sets, begins), ngram_join.signatures(sets, begins).tolist()

    whole = list(made())
    assert [len(s) for s, *_ in whole][:6] == [0, 0, 1, 1, 1, 2] and len(whole[7][0]) == 70
    # All rows of one slice, whose stretches end inside the sets.
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    together = ngram_join.ngram_sets(data, np.cumsum([0, *map(len, texts)]))
    values = ngram_join.signatures(*together)
    for piece, cells in ((1, 1), (10, 3), (100, 64)):
        monkeypatch.setattr(hashing, "PIECE_BYTES", piece)
        monkeypatch.setattr(hashing, "STRETCH", 64 * piece if piece < 100 else 16)
        monkeypatch.setattr(hashing, "_UP", hashing._powers(hashing.BASE, hashing.STRETCH))
        monkeypatch.setattr(hashing, "_DOWN", hashing._powers(hashing.INVERSE, hashing.STRETCH))
        monkeypatch.setattr(ngram_join, "CELLS", cells)
        assert list(made()) == whole
        assert (ngram_join.signatures(*together) == values).all()
        assert ngram_join.set_keys(*together) == [k for _, (k,), _ in whole]
