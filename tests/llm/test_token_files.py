from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgersync.llm import token_files as tf

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _brute(rows):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("n", [1, 63, 64, 65, 5000, 16_384, 70_001, 300_000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (np.minimum(rng.zipf(1.2, n), 49_407), np.full(n, 7), rng.integers(0, 60_000, n)):
        data = tf.encode_segment(ids.astype(np.uint32))
        assert (tf.decode_segment(data) == ids).all()


def test_size_is_near_the_entropy_and_damage_is_seen():
    ids = np.minimum(np.random.default_rng(1).zipf(1.3, 400_000), 49_407).astype(np.uint32)
    p = np.bincount(ids) / len(ids)
    p = p[p > 0]
    data = tf.encode_segment(ids)
    assert len(data) < 1.01 * len(ids) * -(p * np.log2(p)).sum() / 8 + 50_000  # with table and checkpoints
    broken = bytearray(data)
    broken[-1000] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        tf.decode_segment(bytes(broken))


def test_query_equals_whole_text_encoding(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, tf.op9_token_files(spark, sf_dir).collect())) == _brute(rows)


def test_hostile_rows(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(tf, "KNOWN_WORDS", 3)
    texts = [None, "", " \n\t", "Don't  STOP now  é é ΟΔΟΣ 漢字 \x1c x\x85y", "a" * 3000, "word " * 70_000, "İI'LL 12,345 𝒳 <|endoftext|> b", "́x y"]
    rows = [(i - 3, t, "en", "s") for i, t in enumerate(texts)] + [(None, "no id", None, None)]
    path = str(tmp_path / "out")
    tf.write_token_files(documents(rows), path, VOCABULARY)
    got = tf.read_token_files(spark, path).collect()
    want = {i: (n, crc) for i, _, n, crc in _brute([r[:2] for r in rows])}
    assert {r.doc_id: (len(r.ids) // 4, zlib.crc32(r.ids)) for r in got} == want and len(got) == len(rows)


def test_empty(spark, documents, tmp_path):
    path = str(tmp_path / "none")
    tf.write_token_files(documents([]), path, VOCABULARY)
    assert tf.read_token_files(spark, path).count() == 0


def test_words_are_looked_up_once_and_letters_merged_directly():
    encoder = tf.WordEncoder(VOCABULARY)
    library, asked = Tokenizer.from_file(VOCABULARY), []
    text = encoder._text
    encoder._text = lambda word: asked.append(word) or text(word)
    words = ["thonder", "ÉCOLE", "éÿàß", "Ünder.", "straße", "don't", "×a", "÷b", "x1y", "漢字", "İI", "ﬁn", "a\x1cb", "naïve,"]
    sentence = " ".join(words * 3)
    assert np.frombuffer(encoder([sentence.encode()])[0], "<u4").tolist() == library.encode(sentence, add_special_tokens=False).ids
    assert {b"thonder", b"stra\xc3\x9fe", "École".encode()[:2] + b"cole"}.isdisjoint(asked)
    assert len(asked) == len(set(asked)) < len(words)


def test_a_vocabulary_of_other_bytes_takes_the_librarys_way(monkeypatch):
    monkeypatch.setattr(tf, "_FOR_BYTES", {})  # now letters beyond ASCII would come out wrong
    sentence = "Élève thonder àâ é"
    want = Tokenizer.from_file(VOCABULARY).encode(sentence, add_special_tokens=False).ids
    assert np.frombuffer(tf.WordEncoder(VOCABULARY)([sentence.encode()])[0], "<u4").tolist() == want
