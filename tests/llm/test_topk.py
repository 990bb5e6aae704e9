from __future__ import annotations

import numpy as np
import pytest

from ledgersync.llm import topk


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1.0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, norm double, v string")


def _brute(queries, rows, k):
    ok = [(i, np.floor(1024 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in queries:
        for qv in {tuple(v) for i, v in ok if i == q}:
            scored = sorted((-int(np.dot(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_equals_brute_force(spark, monkeypatch, spread):
    for name, n in (("VECTORS_PER_BLOCK", 64), ("QUERIES_PER_BLOCK", 4), ("STRIP", 16), ("PAIRS", 50)):
        monkeypatch.setattr(topk, name, n)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)) * np.exp(spread * rng.normal(size=(400, 1)))
    rows = [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[3][1]) for i in range(20)]  # ties
    rows += [(2000, None), (2001, []), (2002, [1.0] * 7 + [None]), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (2100, [0.0] * 8), (2101, [1.0, 2.0]), (2200, [3.0, 1.0])]
    df = _table(spark, rows)
    queries = [i for i, _ in rows if i % 20 == 0]
    got = topk.exact_top_k(df.where("vec_id % 20 = 0"), df, k=5)
    assert sorted(map(tuple, got.collect())) == _brute(queries, rows, 5)


def test_empty_and_few(spark):
    none = _table(spark, [])
    assert topk.exact_top_k(none, none).count() == 0
    two = _table(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0])])
    got = topk.exact_top_k(two.where("vec_id = 0"), two)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 524288), (0, 2, 1, 524288)]
