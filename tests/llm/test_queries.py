"""The registered queries against their SQL, and the pipeline's stages against
brute force, on the small tables."""

import re

import pytest

from oracle_compare import compare, duck
from tests.conftest import SF_MID, SF_SMALL
from zonepulse.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    n, problems = compare(spark, duck(SF_MID), name, QUERIES[name], ORACLE_SQL[name], SF_MID)
    assert n > 0 and not problems


def test_all_ten_are_registered_with_the_pipeline():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(x.startswith(f"op{n}_") for x in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from zonepulse.llm.common import stored

    from tests.llm.test_ngram_join import brute

    docs = p.read(spark, SF_SMALL, "documents")
    columns = docs.columns
    seen = [docs]
    for name, stage in p.STAGES:
        seen.append(stored(stage(spark, seen[-1], SF_SMALL), f"test-{name}"))
    assert [d.columns for d in seen[:-1]] == [columns] * 5
    rows = [[(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()] for d in seen[:-1]]
    assert set(rows[1]) <= set(rows[0])
    first = {}
    for i, t in sorted(rows[1]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    assert sorted(i for i, _ in rows[2]) == sorted(first.values())
    assert sorted((i for i, _ in rows[3]), key=str) == brute(rows[2])[1]
    assert set(rows[4]) <= set(rows[3]) and max(rows[4].count(r) for r in set(rows[4])) <= 2
    packed = seen[5].groupBy("doc_id").sum("length").count()
    assert packed == len(set(rows[4]))


def test_the_run_keeps_the_copy_of_its_last_stage_alone(spark, monkeypatch):
    import os

    import corpus_pipeline as p
    from zonepulse.session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    names = [name for name, _ in p.STAGES if name != "toxicity"]
    monkeypatch.setattr(p, "STAGES", [s for s in p.STAGES if s[0] in names])
    before = set(os.listdir(root))
    out = p.run(spark, SF_SMALL)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before}
    assert left == {"stage-packing"} and out.count() > 0
