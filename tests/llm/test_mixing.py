from __future__ import annotations

from collections import defaultdict

from ledgersync.llm.mixing import mix_sources, mixed_documents

BLOCK = 4


def _level(sizes, weights, share, most):
    """Targets by resharing the excess again and again."""
    target = dict.fromkeys(sizes, 0.0)
    left, full = share * sum(sizes.values()), set()
    while left > 1e-9 and len(full) < len(sizes):
        open_w = sum(weights[s] for s in sizes if s not in full)
        gain = {s: left * weights[s] / open_w for s in sizes if s not in full}
        left = 0.0
        for s, g in gain.items():
            room = most * sizes[s] - target[s]
            target[s] += min(g, room)
            left += max(0.0, g - room)
            if g >= room:
                full.add(s)
    return target


def _corpus(documents):
    rows = []
    for i in range(300):
        src = ["a", "b", None, "c"][0 if i % 3 == 0 else i % 4]
        rows.append((i, " ".join(["w"] * (i % 37)) if i % 11 else None, "en", src))
    rows += [(7, "w w w", "en", "a")] * 3 + [(None, "w\tw\nw", None, "b"), (1000, " \n ", "en", "d"), (1001, "x " * 5000, "en", "c")]
    return rows, documents(rows)


def test_targets_and_words_taken(documents):
    rows, df = _corpus(documents)
    got = mix_sources(df, block_words=BLOCK).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, _, src in rows:
        sizes[src] += len((text or "").split())
    names = sorted([s for s in sizes if s is not None]) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want = _level(dict(sizes), weights, 1.5, 2)
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.first + r.second
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 8 * BLOCK for s in names), (taken, want)
    again = mix_sources(df.repartition(7), block_words=BLOCK).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents_hold_the_words_taken(documents):
    rows, df = _corpus(documents)
    df = df.where("doc_id <> 7")
    taken = {r.doc_id: r.taken for r in mix_sources(df, block_words=BLOCK).collect()}
    out = mixed_documents(df, block_words=BLOCK)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert all(words[i] == n for i, n in taken.items())


def test_nothing_to_mix(documents):
    assert mix_sources(documents([])).count() == 0
    assert [r.taken for r in mix_sources(documents([(1, None, None, None), (2, "", "en", "a")])).collect()] == [0, 0]
