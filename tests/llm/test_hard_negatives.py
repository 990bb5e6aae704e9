"""Hard negatives against brute force, the recursion against plain products."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgersync.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>, anchor string, score long, place int"


def _brute(rows, k=5):
    """By the rule's own words, in Python integers."""
    sound = [
        (i, r[0], r[1], [int(np.floor(256 * float(np.float32(x)))) for x in r[2]])
        for i, r in enumerate(rows)
        if r[0] is not None and r[1] is not None and r[2] and all(x is not None and np.isfinite(x) for x in r[2])
    ]
    out = []
    for i, a, label, v in sound:
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), b, j, other) for j, b, other, w in sound if j != i and len(w) == len(v)]
        for p, p_id, _, _ in sorted(x for x in scored if x[3] == label)[:k]:
            fits = sorted(x for x in scored if x[3] != label and 80 * -p <= 100 * -x[0] <= 100 * -p)[:k]
            out += [(a, p_id, rank, n_id, -p, -n) for rank, (n, n_id, _, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("m,k,n", [(1, 1, 1), (5, 64, 9), (17, 16, 40), (33, 64, 512), (70, 50, 33), (129, 3, 200)])
def test_recursion_equals_products(m, k, n):
    rng = np.random.default_rng(m)
    a, b = rng.integers(-(2**28), 2**28, (m, k)), rng.integers(-(2**28), 2**28, (k, n))
    for leaf in (1, 4, 16):
        assert (hn.strassen(a, b, leaf) == a @ b).all()


def test_heaps_merge_and_keep_the_earlier_of_ties():
    heaps = hn.Heaps(np.array([-1, 5]), 2)
    heaps.offer(np.array([0, 0, 0, 1]), np.array([3, 3, 3, 9]), np.array([0, 1, 2, 0]))
    heaps.offer(np.array([0, 1]), np.array([7, 6]), np.array([5, 5]))
    assert list(zip(heaps.slot.tolist(), heaps.score.tolist(), heaps.row.tolist(), strict=True)) == [(0, 7, 5), (0, 3, 0), (1, 9, 0), (1, 6, 5)]
    assert heaps.floor.tolist() == [3, 6]


@pytest.mark.parametrize("blocks", [(4, 7), (4096, 8192)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hn, "ANCHORS_PER_BLOCK", blocks[0])
    monkeypatch.setattr(hn, "ROWS_PER_BLOCK", blocks[1])
    monkeypatch.setattr(hn, "STRIP", 5)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(160):
        center = np.eye(6)[i % 3] + 0.2
        rows.append((100 * (i // 8) if i % 8 == 0 else i, int(rng.integers(0, 4)), (center + rng.normal(0, 0.3, 6)).round(1).tolist(), "x", 1, 2))
    rows += [(200, 1, rows[3][2], "x", 1, 2)] * 3  # repeated rows, anchors too
    rows += [(7, 2, rows[3][2], "x", 1, 2), (2**53 + 1, 3, rows[3][2], "x", 1, 2), (2**53, 3, rows[3][2], "x", 1, 2)]  # ties by id
    rows += [(300, None, [1.0] * 6, None, None, None), (400, 1, None, "x", 1, 2), (500, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x", 1, 2)]
    rows += [(600, 1, [float("nan")] * 6, "x", 1, 2), (700, 1, [float("inf")] * 6, "x", 1, 2), (800, 1, [], "x", 1, 2), (None, 1, [1.0] * 6, "x", 1, 2)]
    rows += [(900, 1, [1.0, 2.0], "x", 1, 2), (901, 1, [1.0, 2.0], "x", 1, 2), (902, 2, [1.0, 1.7], "x", 1, 2)]  # another length
    rows += [(1000, 0, [-1.0] * 6, "x", 1, 2), (1100, 9, [0.0] * 6, "x", 1, 2), (1101, 9, [0.0] * 6, "x", 1, 2)]
    got = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(5), F.col("vec_id") % 100 == 0)
    want = _brute(rows)
    assert len(want) > 100 and any(r[4] == 0 for r in want)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_empty(spark):
    got = hn.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0)
    assert got.collect() == []
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_query_equals_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    want = con.execute(hn.SQL["op12_hard_negatives"]).fetchall()
    got = [tuple(r) for r in hn.QUERIES["op12_hard_negatives"](spark, sf_dir).collect()]
    assert want and sorted(got) == sorted(want)
