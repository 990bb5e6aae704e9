from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from sentencepiece import SentencePieceProcessor

from ledgersync.llm.pieces import BPE, SPACE, Pieces, digests

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def test_ids_are_the_librarys_for_all_documents(spark, sf_dir):
    library = SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in digests(docs, MODEL).collect():
        want = library.encode(texts[r.doc_id])
        assert r.round_trip and r.n_ids == len(want) and r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())


def test_hostile_texts_and_the_stream_against_the_library():
    library, ours = SentencePieceProcessor(model_file=MODEL), Pieces(MODEL)
    assert ours.type == BPE
    for w in ("international", "information", "understanding"):
        assert len(_ids(ours.encode(w))) == 1
    rng = random.Random(5)
    texts = [" ", "\n\n", "  a  b ", "x" * 5000, "word " * 3000, "é漢\x00 ", " ▁x", " " * 999, "abandonedinterest" * 700, "-" * 3001, "=#" * 999]
    for n in [1, 2, 15, 40, 49, 200, 1500]:
        for letters in ("ab", "the interning of", "aé漢 \n\t", "ethraniosl  ", "ethraniosl", " -=*#/.", "日本語の中国人"):
            texts += ["".join(rng.choice(letters) for _ in range(n)) for _ in range(3)]
    for text in texts:
        want = library.encode(text)
        assert _ids(ours.encode(text)) == want, text[:80]
        assert [i for some in ours.stream_merged(SPACE + text.replace(" ", SPACE)) for i in some] == want, text[:80]


def test_window_of_merges_stays_bounded():
    parts = list(Pieces(MODEL).stream_merged(SPACE + "abandonedinterest" * 3000))
    assert len(parts) > 500 and max(map(len, parts)) < 200


def test_beginnings_off_the_path_are_not_looked_at():
    ours = Pieces(MODEL)
    word = SPACE + "internationalisation"
    assert [i for some in ours.stream_merged(word) for i in some] == SentencePieceProcessor(model_file=MODEL).encode(word[1:])
    assert len(ours.neighbours) < len(word) // 2


def test_frequent_words_outlive_a_full_table(monkeypatch):
    from ledgersync.llm import pieces

    monkeypatch.setattr(pieces, "KNOWN", 100)
    ours, searched = Pieces(MODEL), []
    search = ours._search
    monkeypatch.setattr(ours, "_search", lambda part: searched.append(part) or search(part))
    library, rng = SentencePieceProcessor(model_file=MODEL), random.Random(2)
    for _ in range(60):
        text = " ".join(w for _ in range(10) for w in ("the", "".join(rng.choices("etaoin", k=8))))
        assert _ids(ours.encode(text)) == library.encode(text)
    assert searched.count(SPACE + "the") == 1 and len(searched) > 500
    assert len(ours.known) < 200 and sum(len(t) for t in (ours.known, ours.older)) < 400
