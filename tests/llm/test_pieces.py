from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from ledgersync.llm.pieces import SPACE, Pieces, decode_documents, digests, encode_documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return Pieces(MODEL)


def _whole_search(v: Pieces, text: str) -> list[int]:
    """Viterbi over the whole text, all backpointers kept."""
    best = [(0.0, 0, None)] + [None] * len(text)
    for i in range(len(text)):
        for end, score, piece in v.arcs(text, i):
            if best[end] is None or best[i][0] + score > best[end][0]:
                best[end] = (best[i][0] + score, i, piece)
    ids, end = [], len(text)
    while end:
        _, start, piece = best[end]
        ids[:0] = [piece] if piece is not None else [v.byte_id[b] for b in text[start:end].encode()]
        end = start
    return ids


def _ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def _fields(data, at, end):
    """(field, start, end) of the values of a message in protocol buffer coding."""

    def varint(at):
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 128:
                return value, at

    while at < end:
        tag, at = varint(at)
        if tag & 7 == 0:
            stop = varint(at)[1]
        elif tag & 7 == 2:
            size, at = varint(at)
            stop = at + size
        else:
            stop = at + {1: 8, 5: 4}[tag & 7]
        yield tag >> 3, at, stop
        at = stop


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The model's file with its search method (field 3 of the trainer's settings, field 2 of the file) set from BPE (2) to unigram (1)."""
    data = bytearray(open(MODEL, "rb").read())
    start, end = next((a, b) for field, a, b in _fields(data, 0, len(data)) if field == 2)
    at = next(a for field, a, _ in _fields(data, start, end) if field == 3)
    assert data[at] == 2
    data[at] = 1
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(bytes(data))
    return str(path)


def test_stream_equals_whole_search(unigram):
    vocabulary = Pieces(unigram)
    rng = random.Random(3)
    for n in [1, 2, 15, 16, 17, 40, 200, 1500]:
        for letters in ("ab", "the interning of", "aé漢 \n\t", "ethraniosl  "):
            text = "".join(rng.choice(letters) for _ in range(n))
            marked = SPACE + text.replace(" ", SPACE)
            want = _whole_search(vocabulary, marked)
            assert [i for part in vocabulary.stream(marked) for i in part] == want
            assert _ids(vocabulary.encode(text)) == want
            assert vocabulary.decode(want) == text


def test_never_below_the_librarys_own_search(unigram, spark, sf_dir):
    from sentencepiece import SentencePieceProcessor

    vocabulary, library = Pieces(unigram), SentencePieceProcessor(model_file=unigram)
    words = {w for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect() for w in r.text.split()}
    sure = [w for w in sorted(words) if None not in [p for i in range(len(w)) for _, _, p in vocabulary.arcs(w, i)]]
    assert len(sure) > 1000
    same = 0
    for w in sure:
        theirs, ours = library.encode(w), _ids(vocabulary.encode(w))
        total = [sum(map(library.get_score, ids)) for ids in (theirs, ours)]
        assert total[1] >= total[0], w  # on a few words the library stops short of the greatest sum
        same += theirs == ours
    assert same > 0.99 * len(sure)


def test_window_stays_bounded(vocabulary):
    parts = list(vocabulary.stream(SPACE + "abandonedinterest" * 3000))
    assert len(parts) > 1000 and max(map(len, parts)) < 200


def test_all_documents_and_hostile_rows(spark, sf_dir, documents, vocabulary):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in digests(docs, MODEL).collect():
        want = _ids(vocabulary.encode(texts[r.doc_id]))
        assert r.round_trip and r.n_ids == len(want) and r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
    rows = [None, "", " ", "\n\n", "  a  b ", "x" * 5000, "word " * 40_000, "é漢\x00 ", "a", "a"]
    df = documents([(i, t, "en", "s") for i, t in enumerate(rows)] + [(None, "q", None, None)]).withColumn("ids", F.lit(1))
    assert all(r.round_trip for r in digests(df, MODEL).collect())
    back = decode_documents(encode_documents(df, MODEL), MODEL).collect()
    assert sorted(r.text for r in back) == sorted([t or "" for t in rows] + ["q"])
    assert digests(df.limit(0), MODEL).count() == 0


def test_workers_keep_the_table_of_one_stage():
    import pyarrow as pa
    import public_tokenizers

    from ledgersync.llm import byte_language, common, pieces, shingle_join

    model = public_tokenizers.path("piece_bpe_32k.model")
    assert pieces.pieces(model) is pieces.pieces(model)  # outlives a task
    list(shingle_join._sets(iter([pa.RecordBatch.from_pydict({"text": ["a b c"]})]), 5))
    assert not common._kept
    pieces.pieces(model)
    byte_language._pooled(byte_language.Network.fresh(["en", "fr"], 0), ["words"])
    assert not common._kept
