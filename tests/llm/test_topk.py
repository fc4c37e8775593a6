import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from zonepulse.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int, tile int, id int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, k):
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % 10 == 0:
            hits = sorted((-max(-topk.LONG, min(topk.LONG, sum(x * y for x, y in zip(a, b)))), i) for i, b in fine if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(hits[:k])]
    return sorted(out)


def found(df, k):
    return sorted(tuple(r) for r in topk.search(df, F.col("id") % 10 == 0, k).collect())


def test_matches_brute_force_with_ties_nulls_and_large_numbers(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE", 16)
    monkeypatch.setattr(topk, "QUERY_TILE", 4)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(150)]
    rows += [(200 + i, rows[20][1]) for i in range(40)]  # a common vector
    rows += [(300, None), (301, [1.0, None] * 3), (310, [math.nan] * 6), (302, [math.inf] * 6), (None, [1.0] * 6)]
    rows += [(320, [1.0, 2.0]), (321, [3.0, 4.0]), (330, []), (331, []), (340, [1e17] * 6), (341, [1e9, -1e12, 3e5, 0.1, 0.2, 0.3])]
    rows += [(5, rows[5][1]), (40, rows[41][1])]  # repeated ids
    assert found(frame(spark, rows), 10) == brute(rows, 10)
    assert found(frame(spark, rows), 300) == brute(rows, 300)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_selection_prefers_the_first_of_equal_scores(k):
    scores = np.array([[1.0, 5.0, 5.0, -np.inf, 5.0, 2.0], [0.0] * 6])
    row, ids, got = topk.select(scores, np.arange(6) * 10, k)
    for r in range(2):
        want = sorted(((-s, i * 10) for i, s in enumerate(scores[r]) if s != -np.inf))[:k]
        assert sorted(zip(-got[row == r], ids[row == r])) == want


def test_empty_tables(spark):
    assert found(frame(spark, []), 10) == []
    assert found(frame(spark, [(1, [1.0])]), 10) == []
    assert found(frame(spark, [(10, [1.0])]), 10) == []
