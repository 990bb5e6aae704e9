from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgersync.llm import byte_language as bl


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = bl.Network.fresh(["a", "b", "c"], seed=4)
    for name in ("table", "recurrent", "output"):
        setattr(net, name, [p.astype(np.float64) for p in getattr(net, name)])
    net.bias = net.bias.astype(np.float64)
    codes = rng.integers(0, 256, (7, 5))
    codes[5:, 1] = 256
    labels = rng.integers(0, 3, 5)
    _, grads = net.gradients(codes, labels)
    for p, g in zip(net.parameters(), grads, strict=True):
        hot = np.argsort(-np.abs(g).ravel())[:6]
        for k in hot:
            at = np.unravel_index(k, p.shape)
            old, value = p[at], []
            for step in (1e-2, -1e-2):
                p[at] = old + step
                value.append(net.gradients(codes, labels)[0])
            p[at] = old
            assert (value[0] - value[1]) / 2e-2 == pytest.approx(g[at], rel=0.05, abs=2e-4)


def test_padding_and_company_change_nothing():
    net = bl.Network.fresh(["a", "b"], seed=1)
    texts = ["abc", "x" * 700, "été " * 90, "q"]
    together = bl._pooled(net, texts)
    for k, t in enumerate(texts):
        assert np.allclose(bl._pooled(net, [t])[0], together[k], atol=1e-5)


def test_held_out_accuracy_and_reruns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = bl.op5_byte_language(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    # other columns don't matter, nor does the layout
    shuffled = docs.repartition(3).select("text", "doc_id", "lang", F.lit("z").alias("score"), F.lit(1).alias("lang_pred"))
    again = bl.identify(shuffled, bl.fit(shuffled)).collect()
    assert {r.doc_id: r.lang_pred for r in again} == {r.doc_id: r.lang_pred for r in got}


def test_hostile_rows(documents):
    rows = [(i, f"alpha beta {i}", "en", "s") for i in range(40)] + [(100 + i, f"ωμέγα δέλτα {i}", "el", "s") for i in range(40)]
    rows += [(200, None, "en", None), (201, "", "en", None), (202, "12 %% \n", "el", None), (None, "alpha", None, None), (203, "ώ" * 100_000, None, None), (204, "beta", None, None), (204, "beta", None, None)]
    df = documents(rows)
    got = bl.identify(df, bl.fit(df, per_language=20)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r.lang_pred for r in got}
    assert [by_id[i] for i in (200, 201, 202, 203, 204, None)] == ["und", "und", "und", "el", "en", "en"]
    assert all(r.score == 0 for r in got if r.lang_pred == "und") and by_id[0] == "en" and by_id[100] == "el"
    assert bl.fit(df.limit(0)) is None and bl.identify(df.limit(0), None).count() == 0
    assert {r.lang_pred for r in bl.identify(df, bl.fit(df.where("lang = 'en'"))).collect()} == {"en", "und"}
    assert {r.lang_pred for r in bl.identify(df, None).collect()} == {"und"}
