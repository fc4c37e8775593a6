import math

import numpy as np
import pytest

from zonepulse.llm import lattice as L

SCHEMA = "vec_id long, embedding array<double>, label int, key string, cell long, n int, lead int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, "k", 1, 2, 3) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, threshold=0.9):
    n = len(rows)
    fine = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v) / np.abs(v).max() if ok else None for ok, (_, v) in zip(fine, rows)]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    links = [[j for j in range(n) if j != i and fine[i] and fine[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        first = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), first, rows[i][0] == first))
    return sorted(out, key=str)


def found(df, **options):
    return sorted(map(tuple, L.near_duplicates(df, **options).collect()), key=str)


def near(rng, v, cos):
    z = rng.normal(size=len(v))
    z -= (z @ v) / (v @ v) * v
    return cos * v / np.linalg.norm(v) + math.sqrt(1 - cos * cos) * z / np.linalg.norm(z)


def test_the_lattice_points_are_the_nearest_ones():
    assert L.NEIGHBOURS.shape == (240, 8) and np.allclose((L.NEIGHBOURS**2).sum(axis=1), 2)
    x = np.random.default_rng(1).normal(size=(2000, 8)) * 2
    point = L.nearest(x)
    whole = np.isclose(point, np.rint(point)).all(axis=1)
    assert (np.rint(point[whole].sum(axis=1)) % 2 == 0).all() and np.isclose((point[~whole] - 0.5) % 1, 0).all()
    assert (np.rint((point[~whole] - 0.5).sum(axis=1)) % 2 == 0).all()
    assert (((x - point) ** 2).sum(axis=1) <= 1 + 1e-9).all()  # the covering radius
    # No neighbour of the point is nearer: its Voronoi cell is that of the shortest vectors.
    beside = ((x[:, None] - point[:, None] - L.NEIGHBOURS) ** 2).sum(axis=2).min(axis=1)
    assert (((x - point) ** 2).sum(axis=1) <= beside + 1e-9).all()


def test_recall_at_the_threshold():
    rng = np.random.default_rng(7)
    for dim in (8, 64):
        a = rng.normal(size=(3000, dim))
        a /= np.linalg.norm(a, axis=1)[:, None]
        for cos, least in ((0.9, 0.985), (0.95, 0.9995)):
            b = np.array([near(rng, v, cos) for v in a])
            x, y = L.cells(a), L.cells(b)
            t = L.TABLES
            home = x[:, :t] == y[:, :t]
            probe = (x[:, t:].reshape(len(x), t, -1) == y[:, :t, None]).any(axis=2) | (y[:, t:].reshape(len(x), t, -1) == x[:, :t, None]).any(axis=2)
            assert (home | probe).any(axis=1).mean() >= least


@pytest.mark.parametrize("chunk", [1024, 8])
def test_equals_all_pairs(spark, monkeypatch, chunk):
    """Chains, large groups in chunks, copies, scaled copies, repeated and null
    ids, two dimensions and vectors that take no part."""
    monkeypatch.setattr(L, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(60)]
    base = rng.normal(size=16)
    rows += [(100 + i, near(rng, base, 0.97).tolist()) for i in range(50)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]
    rows += [(300, [2 * x for x in rows[3][1]]), (301, [3 * x for x in rows[3][1]]), (302, [-x for x in rows[3][1]])]
    chain = [np.array(rows[5][1])]
    for _ in range(5):
        chain.append(near(rng, chain[-1], 0.955))
    rows += [(400 + i, v.tolist()) for i, v in enumerate(chain)]
    rows += [(500, None), (501, [1.0, None] * 8), (502, [math.nan] * 16), (503, [math.inf] * 16), (504, [0.0] * 16), (505, []), (506, [-0.0] * 16)]
    rows += [(None, rows[7][1]), (None, None), (600, [1.0, 0.1]), (601, [1.0, 0.2]), (602, [1e300, 1e299]), (603, [1e-300, 1e-301]), (604, [5.0]), (605, [7.0])]
    rows += [(100, rows[9][1]), (101, rows[61][1])]
    want = brute(rows)
    assert found(frame(spark, rows)) == want
    assert sum(r[1] for r in want) > 4000


def test_another_threshold_links_no_more_than_it_says(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=8)
    rows = [(i, near(rng, base, 0.98).tolist()) for i in range(30)]
    assert found(frame(spark, rows), threshold=0.97) == brute(rows, 0.97)


def test_empty_tables(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(1, None)])) == [(1, 0, 1, True)]
    assert found(frame(spark, [(1, [1.0, 2.0])])) == [(1, 0, 1, True)]
