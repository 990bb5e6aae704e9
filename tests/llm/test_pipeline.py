from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from test_shingle_join import _brute

import __spark_entry__ as entry_module
import corpus_pipeline as cp
from ledgersync.llm import registered
from ledgersync.llm.common import stage
from ledgersync.llm.pieces import Pieces


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    junk = spark.createDataFrame([(10_000, "12 34 !!", "en", "src0", 8), (10_001, None, None, None, None), (10_002, "", "en", "src1", 0)], docs.schema)
    before = docs.union(junk)
    # language: clean documents stay, those without letters go
    kept = stage(cp.language_stage(spark, before, sf_dir), "t")
    assert kept.columns == docs.columns and kept.schema == docs.schema
    rows = {r.doc_id: r for r in kept.collect()}
    assert set(rows) == {r.doc_id for r in docs.collect()}
    # near duplicates: the smallest id of each group
    unique = stage(cp.dedup_stage(spark, kept, sf_dir), "t")
    want = {i for i, _, c in _brute([(r.doc_id, r.text) for r in rows.values()]) if i == c}
    assert {r.doc_id for r in unique.collect()} == want and unique.count() == len(want) < len(rows)
    # mixture: words near the targets, nothing more than twice
    mixed = stage(cp.mix_stage(spark, unique, sf_dir), "t")
    sizes, taken, times = defaultdict(int), defaultdict(int), Counter()
    for r in unique.collect():
        sizes[r.source] += len(r.text.split())
    for r in mixed.collect():
        assert r.text == rows[r.doc_id].text or rows[r.doc_id].text.split()[: len(r.text.split())] == r.text.split()
        taken[r.source] += len(r.text.split())
        times[r.doc_id] += 1
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes))}
    level, low, high = 0.0, 0.0, 2.0 * sum(sizes.values())
    for _ in range(100):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(2 * sizes[s], weights[s] * level) for s in sizes) < 1.5 * sum(sizes.values()) else (low, level)
    assert all(abs(taken[s] - min(2 * sizes[s], weights[s] * level)) <= 10 * 32 for s in sizes) and max(times.values()) == 2
    # token ids
    vocabulary = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    ids = cp.encode_stage(spark, mixed, sf_dir).collect()
    assert Counter((r.doc_id, r.ids) for r in ids) == Counter((r.doc_id, bytes(vocabulary.encode(r.text))) for r in mixed.collect())
    assert all(r.round_trip and r.n_ids * 4 == len(r.ids) for r in ids)
    assert vocabulary.decode(np.frombuffer(ids[0].ids, "<u4").tolist())


def test_run_on_hostile_documents(spark, documents, tmp_path):
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s") for i, t in enumerate([None, "", "one two three four five six", "one two three four five six", "é " * 20_000, "12"])]
    documents(rows + [(None, "no id at all", None, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in cp.run(spark, str(tmp_path)).collect()} <= {2, 4, None}
    empty = tmp_path / "none"
    documents([]).write.parquet(str(empty / "documents.parquet"))
    assert cp.run(spark, str(empty)).count() == 0


def test_decisions_are_made_for_rows(spark, sf_dir, documents):
    words = "one two three four five six seven eight nine ten"
    lonely, other = "a text that nothing else here comes near to at all", "quite different words stand in this document of ours"
    rows = [(1, words, "en", "s")] * 3 + [(2, words, "en", "s"), (3, words, "en", "t"), (3, other, "en", "s"), (None, words, "en", "s"), (None, lonely, "en", "s")]
    df = documents(rows).withColumnsRenamed({"size": "row", "taken": "key"}).repartition(4)  # names the stages use themselves
    unique = cp.dedup_stage(spark, df, sf_dir)
    assert unique.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in unique.collect()), key=str) == sorted([(1, words), (3, other), (None, lonely)], key=str)
    several = documents([(7, f"word{i} " * 40, "en", "s") for i in range(30)] + [(None, f"null{i} " * 40, "en", "t") for i in range(30)])
    mixed = cp.mix_stage(spark, several, sf_dir).collect()
    taken = Counter()
    for r in mixed:
        taken[r.source] += len(r.text.split())
    # weights 3 and 1 share 3600 words: the first source stops at twice its size, the rest goes to the other
    assert abs(taken["s"] - 2400) <= 320 and abs(taken["t"] - 1200) <= 320


def test_rejection_by_score(spark, sf_dir, documents, monkeypatch):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the good words of the north " * 5, "en"), ("les bons mots du grand nord " * 5, "fr")] * 200)]
    clean = documents(rows)
    odd = documents([(1000, "12 ½ ² 3 ①", None, "s"), (1001, "!!", None, "s"), (1002, None, None, "s"), (1003, "the words", None, "s")])
    kept = {r.doc_id for r in cp.language_stage(spark, clean.union(odd), sf_dir).collect()}
    assert kept == set(range(400)) | {1003}
    monkeypatch.setattr(cp, "ABOVE_CHANCE", 2.0)  # certainty in one of two languages
    assert cp.language_stage(spark, clean.union(documents([(1004, "x", None, "s")])), sf_dir).where("doc_id = 1004").count() == 0


def test_everything_is_registered():
    names = entry_module.queries()
    assert "pipeline" in names and cp.ORACLE_SQL is None
    assert [n for n in range(1, 14) if sum(x.startswith(f"op{n}_") for x in names) != 1] == []
    assert set(registered.SQL) <= set(registered.QUERIES) <= set(names) and set(registered.SQL) <= set(entry_module.oracle_sql())


def test_batches_bounded_by_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for given, wanted in ((str(64 << 20), cp.BATCH_BYTES), (str(1 << 30), cp.BATCH_BYTES), ("4096", 4096)):
            spark.conf.set(key, given)
            cp.bound_batches(spark)
            assert int(spark.conf.get(key).rstrip("b")) == wanted
    finally:
        spark.conf.set(key, before)


def test_mix_shuffles_texts_once(spark, documents):
    mixed = cp.mix_stage(spark, documents([(i, f"some words {i}", "en", "s") for i in range(20)]), "")
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    rows = re.findall(r"struct\(([^)]*)\) AS row#", plan)
    assert rows and all("doc_id" in r and "text" not in r for r in rows)
