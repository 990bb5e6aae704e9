"""The trie against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgersync.llm import prefix_trie as trie


def _brute(rows):
    """By the rule's own words; ``rows``: (conv_id, turn, role, text)."""
    mine = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, mine(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    seqs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        seqs[c] = [*own.get(base, [])[:h], *ts[h:]]
    members = defaultdict(list)
    for c, ts in seqs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = sum(saved[c] for c in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(seqs[c]) == len(p))))
        up = min(members[p[:-1]]) if p else None
        out.append((min(cs), len(p), up, len(cs), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _run(spark, rows):
    full = [(*r, "x", "y", 1) for r in rows]
    frame = spark.createDataFrame(full, "conv_id long, turn int, role string, text string, head string, ids string, n int").repartition(3)
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    got = trie.prefix_trie(trie.rebuilt(trie.sequences(frame), shared, F.expr("conv_id - conv_id % 100"), 5))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(2)
    rows = []
    for c in range(0, 420):
        if c == 200:  # a base that is absent
            continue
        for t in range(rng.randint(0, 7)):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["hi", "漢字 x", "so?", ""])))
    for c in range(1000, 1100):  # copies, and copies that end differently after a long common part
        rows += [(c, t, "user", f"turn {t}") for t in range(30)] + ([(c, 31, "bot", f"end {c % 7}")] if c % 2 else [])
    rows += [(-7, 0, "user", "below zero"), (-100, 0, "bot", "base below zero"), (2**53 + 1, 1, "user", "large"), (None, 1, "user", "no id")]
    rows += [(5, None, "user", "null turn")] * 2 + [(5, 1, None, None), (5, 1, "", "x"), (6, 2, "a", "bc"), (6, 2, "ab", "c"), (7, 0, "user", "long " * 4000)]
    return rows


@pytest.mark.parametrize("limit", [1, 20, 512, 10**9])
def test_equals_brute_force(spark, mixed, monkeypatch, limit):
    monkeypatch.setattr(trie, "CONTAINER_TURNS", limit)
    assert _run(spark, mixed) == _brute(mixed)


def test_ids_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PACK", 20)
    rows = [(c, t, "u", "same") for c in range(600, 700) for t in range(9)] + [(c, 0, "u", "x") for c in range(7)]
    assert _run(spark, rows) == _brute(rows)


def test_empty_and_single(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(None, 1, "u", "x")]) == []
    for rows in ([(3, 1, None, None)], [(100, 1, "u", "x")], [(3, 0, "u", "x"), (0, 0, "u", "x")]):
        assert _run(spark, rows) == _brute(rows)


def test_rounds_do_not_grow_with_the_depth(spark, monkeypatch):
    rounds = []
    real = trie.stage
    monkeypatch.setattr(trie, "stage", lambda df, name: rounds.append(name) or real(df, name))
    monkeypatch.setattr(trie, "CONTAINER_TURNS", 50)
    rows = [(c, t, "u", f"turn {t}" if t < 200 else f"end {c}") for c in range(100, 400, 100) for t in range(201)]
    assert _run(spark, rows) == _brute(rows)
    assert rounds.count("trie-chains") == 2  # one burst, one look that finds nothing more


def test_query_equals_brute_force_and_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf_dir}/conversations.parquet')")
    want = sorted(con.execute(trie.SQL["op11_prefix_trie"]).fetchall(), key=str)
    got = sorted((tuple(r) for r in trie.QUERIES["op11_prefix_trie"](spark, sf_dir).collect()), key=str)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == want == _brute(rows)
