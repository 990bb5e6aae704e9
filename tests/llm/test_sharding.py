"""Shards against a sorted list of all rows, and the search for splitters against cumulative sums."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgersync.llm import sharding


def _rows(df):
    return [r.asDict() for r in df.collect()]


def _check(source, got, n_shards, tolerance=0.01):
    """``source``: (id, text). Everything is there once, slots are gapless, and edges are as near as rows allow."""
    data = lambda t: (t or "").encode()
    want = sorted((str(i), len(data(t)) + 8, zlib.crc32(data(t))) for i, t in source)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    shards = defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < n_shards
        shards[r["shard"]].append(r)
    for rows in shards.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    total, share = sum(r["size"] for r in got), sum(r["size"] for r in got) / n_shards
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    below, edges = 0, [0]
    for r in order:
        below += r["size"]
        edges.append(below)
    ends = [sum(r["size"] for r in got if r["shard"] < k) for k in range(1, n_shards)]
    for k, end in enumerate(ends, 1):
        target = total * k // n_shards
        assert end in edges
        assert abs(end - target) <= max(tolerance * share, min(abs(e - target) for e in edges))
    return order


def _order(source):
    """Rows in the order of the key: hash of the text, id."""
    h = lambda t: "0" * 16 if t is None else hashlib.md5(t.encode()).hexdigest()[:16]
    return sorted(source, key=lambda r: (h(r[1]), r[0] is not None, r[0] or 0))


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["ab", "漢字", "cde", "x"], k=rng.randint(1, 60)))) for i in range(1500)]
    rows += [(2000 + i, "the same text in many rows") for i in range(700)]  # a group of about a third
    rows += [(3, rows[3][1])] * 40 + [(-5, "minus"), (2**53 + 1, "large"), (2**53, "large"), (None, "no id"), (None, None), (8, None), (9, ""), (10, "long " * 3000)]
    return rows


def _frame(spark, rows, kind="long"):
    full = [(i, t, "x", 1, "key", 2) for i, t in rows]
    return spark.createDataFrame(full, f"doc_id {kind}, text string, shard string, Size int, key string, _place int").repartition(7)


@pytest.mark.parametrize("probes", [4, 4096])
def test_laws(spark, mixed, monkeypatch, probes):
    monkeypatch.setattr(sharding, "PROBES", probes)
    frame = sharding.shards_by_bytes(_frame(spark, mixed))
    assert frame.columns == ["doc_id", "text", "key", "_place", "size", "text_crc32", "shard", "slot"]
    order = _check(mixed, got := _rows(frame), 24)
    assert [(r["doc_id"], r["text"]) for r in order] == _order(mixed)
    assert len({r["shard"] for r in got if r["text"] == "the same text in many rows"}) > 1  # the hot group is spread


def test_ranges_inside_shards(spark, mixed, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_BYTES", 500)
    frame = sharding.shards_by_bytes(_frame(spark, mixed), n_shards=5)
    order = _check(mixed, _rows(frame), 5)
    assert [(r["doc_id"], r["text"]) for r in order] == _order(mixed)
    assert frame.rdd.getNumPartitions() > 100


def test_small_groups_stay_whole(spark):
    rng = random.Random(9)
    texts = [f"{rng.random()} " * rng.randint(1, 8) for _ in range(4000)]
    rows = [(i, t) for i, t in enumerate(texts + texts)]  # pairs, each far below a hundredth of a share
    got = _rows(sharding.shards_by_bytes(_frame(spark, rows), n_shards=8))
    _check(rows, got, 8)
    where = defaultdict(set)
    for r in got:
        where[r["text"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


@pytest.mark.parametrize("rows", [[], [(1, "one")], [(1, None)], [(1, "a"), (2, "b"), (3, "giant " * 500)], [(7, "same")] * 50])
def test_few_rows(spark, rows):
    _check(rows, _rows(sharding.shards_by_bytes(_frame(spark, rows))), 24)


def test_text_ids_and_files(spark, tmp_path):
    rows = [(f"id{i}", f"text {i % 40} " * (i % 11)) for i in range(500)]
    sharding.write_shards(_frame(spark, rows, "string"), str(tmp_path / "shards"), n_shards=3)
    read = spark.read.parquet(str(tmp_path / "shards")).withColumn("file", F.input_file_name())
    _check(rows, got := _rows(read), 3)
    assert len({r["file"] for r in got}) == 3


def test_rerun_agrees(spark, sf_dir):
    run = lambda: sorted(map(tuple, sharding.QUERIES["op13_byte_shards"](spark, sf_dir).collect()))
    assert run() == run()


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = _rows(sharding.QUERIES["op13_byte_shards"](spark, sf_dir))
    assert list(got[0]) == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
    order = _check(docs, got, 24)
    assert [r["doc_id"] for r in order] == [i for i, _ in _order(docs)]
