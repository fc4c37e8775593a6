import hashlib
import re
import zlib

import pytest
from zonepulse.llm import dedup, sharding

ROWS = [
    (5, "a b"), (3, "a\t\n b"), (3, "a  b"), (9, "a b "), (None, "a b"), (7, None), (8, ""), (2, " "), (None, "lone"),
    (None, "none"), (None, "none"), (11, "x" * 200_000), (12, "x" * 200_000), (13, "A b"),
]


def clean(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected_groups(rows):
    by = {}
    for i, t in rows:
        by.setdefault(clean(t), []).append(i)
    out = []
    for t, ids in by.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest, left = hashlib.sha256(t.encode()).hexdigest(), True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and left, digest))
            left = left and i != keep
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [64, 1 << 26])
def test_groups_match_brute_force_even_with_a_full_filter(make_docs, bits):
    got = [tuple(r) for r in dedup.exact_groups(make_docs(ROWS), bits=bits).collect()]
    assert sorted(got, key=str) == expected_groups(ROWS)


def test_hot_group_of_more_rows_than_a_partition(make_docs):
    rows = [(i, "same text") for i in range(3_000)] + [(10_000 + i, f"t{i}") for i in range(500)]
    got = dedup.exact_groups(make_docs(rows)).where("group_size > 1").agg({"keep_id": "max", "doc_id": "count"}).first()
    assert sorted(got) == [0, 3_000]


def test_dedup_keeps_whole_rows_and_clashing_columns(clashing):
    docs = clashing(ROWS)
    kept = dedup.dedup(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, clean(r.text), r.sha) for r in kept.collect()), key=str)
    want = sorted({(min((i for i, t in ROWS if clean(t) == c and i is not None), default=None), c) for c in {clean(t) for _, t in ROWS}}, key=str)
    assert [x[:2] for x in got] == want
    assert all(x[2] == (None if x[0] is None else x[0] + 1) for x in got)


def test_empty_tables(make_docs):
    none = make_docs([])
    assert dedup.exact_groups(none).count() == 0
    assert dedup.dedup(none).count() == 0
    assert sharding.shard(none, 4).count() == 0


def test_rows_the_filter_clears_do_not_shuffle(make_docs):
    from tests.conftest import plan_text

    straight, marked = plan_text(dedup.dedup(make_docs([(i, f"text {i}") for i in range(50)])), "simple").split("Aggregate", 1)
    assert "Union" in straight and "hashpartitioning" not in straight
    assert "Python" not in marked.replace("PythonRDD", "")


def test_shards_are_near_equal_and_gapless(make_docs):
    rows = [(i, "x" * (i * 37 % 500)) for i in range(2_000)] + [(None, None), (1, "twice"), (1, "twice"), (50_000, "é" * 100_000)]
    got = sharding.shard(make_docs(rows), 7).collect()
    assert len(got) == len(rows)
    size = {}
    places = {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r["size"]
        places.setdefault(r.shard, []).append(r.slot)
    long = 200_016  # the one document that outweighs a shard
    rest = [s for s in size.values() if s < long]
    assert max(rest) - min(rest) <= 0.05 * sum(rest) / len(rest)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    by_id = {r.doc_id: r for r in got}
    assert by_id[50_000]["size"] == long and by_id[50_000].text_crc32 == zlib.crc32(("é" * 100_000).encode())
    assert by_id[None]["size"] == 16 and by_id[None].text_crc32 == 0


def test_map_versions_move_few_slots(spark, tmp_dir):
    sizes = {i: 10 + i % 7 for i in range(1_000)}
    old = sharding.rebalanced(sharding.even_map(10, 1_000), sizes, 10)
    new = sharding.rebalanced(old, sizes, 11)
    moved = [i for i in range(1_000) if old[i] != new[i]]
    assert len(moved) < 100 and sum(new[i] == 10 for i in moved) > 0.8 * len(moved)
    load = [sum(sizes[i] for i in range(1_000) if new[i] == k) for k in range(11)]
    assert max(load) - min(load) <= 16
    sharding.save_map(spark, tmp_dir + "/map", 0, old)
    sharding.save_map(spark, tmp_dir + "/map", 1, new)
    assert {r.slot: r.shard for r in sharding.load_map(spark, tmp_dir + "/map").collect()} == dict(enumerate(new))
    assert {r.slot: r.shard for r in sharding.load_map(spark, tmp_dir + "/map", 0).collect()} == dict(enumerate(old))


def test_a_stored_map_is_edited_and_places_the_rows(spark, make_docs, tmp_dir):
    docs = make_docs([(i, "x" * (i % 90)) for i in range(4_000)])
    first = {r.doc_id: r for r in sharding.shard(docs, 40, folder=tmp_dir).collect()}
    grown = {r.doc_id: r for r in sharding.shard(docs, 41, folder=tmp_dir).collect()}
    moved = [i for i in first if first[i].shard != grown[i].shard]
    assert sum(first[i]["size"] for i in moved) <= 2 / 41 * sum(r["size"] for r in first.values())
    assert {r.map_version for r in first.values()} == {1} and {r.map_version for r in grown.values()} == {2}
    _, stored = sharding.newest_map(spark, tmp_dir)
    assert all(stored[r.virtual_slot] == r.shard for r in grown.values()) and len({r.shard for r in grown.values()}) == 41
    fewer = sharding.shard(docs, 3, folder=tmp_dir).collect()
    assert {r.shard for r in fewer} == {0, 1, 2} and {r.map_version for r in fewer} == {3}
    with pytest.raises(ValueError):
        sharding.shard(docs, 3, slots=128, folder=tmp_dir)


def test_a_slot_above_a_shard_leaves_the_others_even():
    sizes = {0: 50_000, **{i: 100 + i * 37 % 400 for i in range(1, 2_000)}}
    new = sharding.rebalanced(sharding.even_map(40, 2_000), sizes, 40)
    load = [sum(sizes[i] for i in sizes if new[i] == k) for k in range(40)]
    rest = sorted(load)[:-1]
    assert max(load) == 50_000 and max(rest) - min(rest) <= 0.01 * sum(rest) / len(rest)


def test_repeated_rows_spread_over_shards(make_docs):
    rows = [(5, "the same text")] * 600 + [(None, "no id, the same")] * 600 + [(i, f"text {i}") for i in range(600)]
    got = sharding.shard(make_docs(rows), 6).collect()
    assert sorted((r.doc_id or -1, r.text_crc32) for r in got) == sorted((i or -1, zlib.crc32(t.encode())) for i, t in rows)
    assert len({r.virtual_slot for r in got if r.doc_id == 5}) > 500
    size = {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r["size"]
    assert len(size) == 6 and max(size.values()) - min(size.values()) <= 0.02 * sum(size.values()) / 6
    assert all(sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got))) for k in size)
