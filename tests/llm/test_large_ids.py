"""Ids above 2**53 and null ids in one partition come out as they went in; registered SQL can be run."""

from __future__ import annotations

import duckdb
import pytest

from ledgersync.checks.compare import compare
from ledgersync.llm import byte_language, licences, registered, topk, vector_dedup, wrappers

BIG = 2**53 + 1


def _one(spark, rows, schema):
    return spark.createDataFrame(rows, schema).coalesce(1)


def test_articles(spark):
    page = "<html><body><article><p>One article of some words.</p></article></body></html>"
    got = wrappers.extract_articles(_one(spark, [(BIG, "http://h/a", page), (None, "http://h/b", page)], "page_id long, url string, html string"))
    assert {r.page_id for r in got.collect()} == {BIG, None}


def test_languages(spark):
    docs = _one(spark, [(BIG, "some words", 1), (None, "words some", None), (3, "½ ² 3 ①", BIG), (4, None, 4)], "doc_id long, text string, n_chars long")
    net = byte_language.train([b"some words", b"mots divers"], [0, 1], ["en", "fr"])
    got = {(r.doc_id, r.n_chars, r.lang_pred == "und") for r in byte_language.identify(docs, net).collect()}
    assert got == {(BIG, 1, False), (None, None, False), (3, BIG, True), (4, 4, True)}


def test_licences(spark):
    text = "Licensed under the Apache License, Version 2.0."
    got = licences.scan_licences(_one(spark, [(BIG, text), (None, text), (1, None)], "doc_id long, text string"))
    assert {r.doc_id for r in got.collect()} == {BIG, None}


def test_top_k(spark):
    rows = [(BIG, [1.0, 2.0]), (None, [9.0, 9.0]), (100, [1.0, 0.0]), (100, [0.0, 1.0]), (BIG + 1, [1.0, 1.0])]
    vectors = _one(spark, rows, "vec_id long, embedding array<float>")
    got = topk.exact_top_k(vectors.where("vec_id = 100"), vectors)
    assert sorted(tuple(r)[1:3] for r in got.collect()) == [(1, BIG), (1, BIG), (2, BIG + 1), (2, BIG + 1)]  # each of the two queries


def test_vectors(spark):
    rows = [(BIG, [1.0, 2.0]), (None, [2.0, 4.0]), (None, [5.0, -1.0])]
    got = vector_dedup.near_duplicates(_one(spark, rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == sorted([(BIG, 1, BIG, True), (None, 1, BIG, False), (None, 0, None, True)], key=str)


@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    note = compare(registered.QUERIES[name](spark, sf_dir), con, registered.SQL[name])
    assert note.startswith("ok") and "EMPTY" not in note, note
