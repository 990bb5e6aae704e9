from __future__ import annotations

import numpy as np
import pytest

from ledgersync.llm import vector_dedup


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, n_links int, rep string")


def _brute(rows, cosine):
    ok = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, group = {k: set() for k in range(len(rows))}, list(range(len(rows)))
    for a in ok:
        for b in ok:
            x, y = rows[a][1], rows[b][1]
            if a != b and len(x) == len(y):
                x, y = np.array(x), np.array(y)
                if (x * y).sum() / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    links[a].add(b)
    for _ in rows:
        for a in ok:
            for b in links[a]:
                group[a] = group[b] = min(group[a], group[b])
    least = {}
    for a in range(len(rows)):
        least[group[a]] = min(least.get(group[a], rows[a][0]), rows[a][0]) if rows[a][0] is not None else least.get(group[a])
    return sorted((rows[a][0], len(links[a]), least[group[a]], rows[a][0] == least[group[a]]) for a in range(len(rows)))


@pytest.mark.parametrize("dim", [3, 24])
def test_equals_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(vector_dedup, "TILE", 37)
    monkeypatch.setattr(vector_dedup, "ROW", 5)
    monkeypatch.setattr(vector_dedup, "STRIP", 8)
    rng = np.random.default_rng(dim)
    x = []
    for c in rng.normal(size=(40, dim)):
        for _ in range(rng.integers(1, 9)):
            x.append(c * rng.uniform(0.2, 3) + rng.normal(size=dim) * 0.22)
    rows = [(7 * i % 1009, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    rows += [(2000 + i, rows[5][1]) for i in range(60)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * dim), (3003, [1.0] * (dim - 1) + [None]), (3004, [float("nan")] * dim), (3005, [float("inf")] * dim), (3006, [1.0] * (dim + 1)), (3007, [-0.0] * (dim - 1) + [2.0]), (3008, [0.0] * (dim - 1) + [2.0]), (3009, [0.0] * (dim - 1) + [1.0]), (rows[9][0], rows[9][1])]
    got = vector_dedup.near_duplicates(_table(spark, rows), 0.95)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 0.95)


def test_empty(spark):
    assert vector_dedup.near_duplicates(_table(spark, [])).count() == 0
