from collections import defaultdict

import pytest
from zonepulse.llm import mixing


def fill(sizes, weights=(5, 2, 1), budget=1.5, cap=2):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), budget * sum(sizes.values())
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        share = {s: cap * sizes[s] if s in full else rest * w[s] / free for s in names}
        above = {s for s in names if s not in full and share[s] > cap * sizes[s]}
        if not above:
            return share
        full |= above


def test_targets_by_water_filling(spark):
    sizes = {"b": 10, "a": 1000, None: 400, "é": 7, "z": 0, "c": 300, "d": 300}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(fill(sizes))


def test_taken_words_are_near_targets_and_reruns_agree(make_docs):
    rows = [(i, "w " * (1 + i * 7919 % 300), "en", ("a", "b", "c", None)[i * i % 7 % 4]) for i in range(1_200)]
    rows += [(None, None, "en", "a"), (5_000, "", "en", "b"), (7, "same", "en", "c"), (7, "same", "en", "c")]
    one = mixing.taken(make_docs(rows, 3)).collect()
    two = mixing.taken(make_docs(rows, 7)).collect()
    assert sorted(map(str, one)) == sorted(map(str, two)) and len(one) == len(rows)
    taken, target, most = defaultdict(int), {}, defaultdict(int)
    for r in one:
        key = r.source_size
        taken[key] += r.taken
        target[key] = r.target
        most[key] = max(most[key], r["size"])
        assert 0 <= r.taken <= 2 * r["size"]
    assert all(abs(taken[k] - target[k]) <= most[k] for k in taken)


def test_mix_emits_whole_rows(clashing):
    docs = clashing([(i, "w " * (i % 9 + 1), "en", "ab"[i % 2]) for i in range(60)] + [(None, None, None, None), (3, "", None, None)])
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id] += len((r.text or "").split())
    want = {r.doc_id: r.taken for r in mixing.taken(docs).collect() if r.taken}
    assert {k: v for k, v in got.items() if v} == want


def test_rows_that_differ_in_another_column_keep_it(make_docs):
    docs = make_docs([(1, "a b", "en", "s")] * 6 + [(2, "c", "en", "t")] * 3)
    numbers = docs.sparkSession.createDataFrame([(k,) for k in range(6)], "extra int")
    docs = docs.where("doc_id = 1").limit(1).join(numbers).unionByName(docs.where("doc_id = 2").limit(1).join(numbers.limit(3)))
    mixed = mixing.mix(docs)
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id, r.extra] += 1
    words = sum(r.taken for r in mixing.taken(docs).collect())
    assert {k for k in got if k[0] == 1} == {(1, k) for k in range(6)} and max(got.values()) <= 2
    assert sum(n * (2 if k[0] == 1 else 1) for k, n in got.items()) == words


def test_equal_rows_spread_over_ranges(spark, make_docs, monkeypatch):
    seen = {}
    keep = mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, name: seen.setdefault(name, keep(df, name)))
    docs = make_docs([(1, "the same", "en", "s")] * 3_000 + [(None, "x", "en", "s")] * 3_000 + [(k, f"t {k}", "en", "s") for k in range(3_000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixing.taken(docs).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [r["count"] for r in seen["mix-ordered"].withColumn("p", mixing.F.shiftright("place", 33)).groupBy("p").count().collect()]
    assert len(parts) == 4 and max(parts) <= 2 * 9_000 / 4


def test_empty_table(make_docs):
    assert mixing.taken(make_docs([])).count() == 0
    assert mixing.mix(make_docs([])).count() == 0
