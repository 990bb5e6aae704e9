"""SentencePiece encoding and decoding with a search that streams.

The vocabulary, its scores and its type come from a model file. A unigram model's ids are the pieces with the greatest
sum of scores. A BPE model's scores are ranks of merges: of all neighbours whose union is a piece, those with the best
one are merged, the leftmost first, until none are left. So every beginning of a text has one last piece: the one that,
joined to the last piece before it, is merged to just these two. (No merge crosses a boundary of the result, so any
neighbours in it are merged alone as within the text; and the first merge across a boundary would also be made by the two
pieces alone.) So beginnings point back to shorter ones, as in the search for sums.

Either search keeps backpointers only for a window behind the reading position. No piece is longer than the longest one
of the vocabulary, so the live ends lie within that length; when the paths of all live ends run through one boundary,
nothing after it can change what lies before, and the ids up to it are committed and forgotten. Word starts are such
boundaries in vocabularies whose pieces have no space but at their start, so words may be searched one by one, and
a worker keeps the ids of words it has met, in tables of bounded size: a full one becomes the older one, from which words
met again move on.

Scale: map-only; texts don't move. Memory beside the text and its ids is the window and the tables.

Defined results: a null or empty text has no ids and decodes to ''; characters without a piece become the ids of their
bytes; of equal sums the path whose pieces end with the longer one wins; control ids decode to nothing. A text with
the space mark U+2581 decodes to one with spaces, as the format has it. Repeated rows and null ids are ordinary rows,
an empty table gives no rows; other columns are ignored. Models of words or characters, or with unused pieces in BPE,
are refused.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from functools import cached_property
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersync.llm.common import kept_in_worker, table

SPACE = "▁"
KNOWN = 150_000  # entries of a worker's table of words, and of the one before it
NEIGHBOURS, BEGINNINGS = 150_000, 100_000  # entries of its tables of pieces side by side, and of last pieces
BEGINNING = 6  # characters
DEPTH = 200  # pieces that are looked up one for another
LONGEST_KNOWN = 48
UNIGRAM, BPE = 1, 2  # the format's numbers of model types
_NO = (-inf, -1)
_CHUNK = re.compile(rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a message in protocol buffer coding."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def model_type(model: bytes) -> int:
    """The type of a model file: field 3 of the trainer's settings, which are field 2 of the file."""
    settings = [value for field, value in _fields(model) if field == 2]
    return next((value for s in settings for field, value in _fields(s) if field == 3), UNIGRAM)


class Pieces:
    """A vocabulary with scores, and the search over it."""

    def __init__(self, model_file: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        self.type = model_type(model.serialized_model_proto())
        if self.type not in (UNIGRAM, BPE) or (self.type == BPE and any(map(model.is_unused, range(model.get_piece_size())))):
            raise ValueError(f"{model_file}: neither a unigram model nor a BPE model without unused pieces")
        self.back: dict = {}  # the pieces read from their ends, for merges
        self.merges: dict[str, tuple[float, int]] = {}
        self.byte_id = [0] * 256
        self.plain: list[bytes] = []  # what an id decodes to
        scores, self.longest, inner = [], 1, set()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.plain.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.plain.append(b"")
            else:
                if self.type == BPE:
                    node = self.back
                    for c in reversed(piece):
                        node = node.setdefault(c, {})
                    node[""] = piece
                self.merges[piece] = (model.get_score(i), i)
                scores.append(model.get_score(i))
                self.longest = max(self.longest, len(piece))
                inner.update(piece[k : k + 2] for k in range(len(piece) - 1))
                self.plain.append(piece.replace(SPACE, " ").encode())
        self.unknown = min(scores) - 10.0
        # no piece runs over the start of a word or a line end
        self.by_word = not any((b == SPACE and a != SPACE) or "\n" in (a, b) for a, b in inner)
        self.inner = frozenset(inner)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the table of words before this one
        self.neighbours: dict[tuple[str, str], bool] = {}
        self.beginnings: dict[str, str] = {}  # last pieces of short beginnings

    @cached_property
    def trie(self) -> dict:
        """The pieces read from their starts, for sums."""
        trie: dict = {}
        for piece, (score, i) in self.merges.items():
            node = trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = (i, score)
        return trie

    def arcs(self, text: str, i: int) -> list[tuple[int, float, int | None]]:
        """(end, score, id) of the pieces that start at ``i``; id None for a character without piece."""
        out, node, end = [], self.trie, i
        for c in text[i : i + self.longest]:
            node = node.get(c)
            if node is None:
                break
            end += 1
            if "" in node:
                piece, score = node[""]
                out.append((end, score, piece))
        if not out or out[0][0] != i + 1:
            out.insert(0, (i + 1, self.unknown, None))
        return out

    def stream(self, text: str) -> Iterator[list[int]]:
        """Yields the ids of ``text`` with the greatest sum of scores as soon as they are certain."""
        # of the boundaries after the last commit, in order: greatest sum, start and id of the last piece
        total, start, last = [0.0], [0], [None]
        done, window, longest = 0, 2 * self.longest, self.longest
        for i in range(len(text)):
            here, node, at, single = total[i - done], self.trie, i - done, False
            for c in text[i : i + longest]:
                node = node.get(c)
                if node is None:
                    break
                at += 1
                if "" in node:
                    piece, score = node[""]
                    single = single or at == i - done + 1
                    while len(total) <= at:
                        total.append(-inf)
                        start.append(i)
                        last.append(None)
                    if here + score > total[at]:
                        total[at], start[at], last[at] = here + score, i, piece
            if not single:
                at = i - done + 1
                if len(total) <= at:
                    total.append(-inf)
                    start.append(i)
                    last.append(None)
                if here + self.unknown > total[at]:
                    total[at], start[at], last[at] = here + self.unknown, i, None
            far = done + len(total) - 1
            if far == i + 1 or i - done >= window:
                live = {end for end in range(i + 1, far + 1) if total[end - done] > -inf}
                while len(live) > 1:  # follow the latest end back until all paths meet
                    end = max(live)
                    live.remove(end)
                    live.add(start[end - done])
                meet = live.pop()
                if meet > done:
                    yield self._path(text, start, last, done, meet)
                    cut, done = meet - done, meet
                    del total[:cut], start[:cut], last[:cut]

    def _path(self, text: str, start: list[int], last: list[int | None], done: int, end: int) -> list[int]:
        ids: list[int] = []
        while end > done:
            piece, before = last[end - done], start[end - done]
            if piece is None:
                ids += [self.byte_id[b] for b in reversed(text[before:end].encode())]
            else:
                ids.append(piece)
            end = before
        ids.reverse()
        return ids

    def merged(self, text: str) -> list[str]:
        """``text`` in the pieces that BPE merges leave of it; for short texts."""
        parts, merges = list(text), self.merges
        scores = [merges.get(a + b, _NO)[0] for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > -inf:
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k:
                scores[k - 1] = merges.get(parts[k - 1] + parts[k], _NO)[0]
            if k < len(scores):
                scores[k] = merges.get(parts[k] + parts[k + 1], _NO)[0]
        return parts

    def _stay(self, a: str, b: str) -> bool:
        """Whether merging leaves ``a`` and ``b`` apart, each as one piece; ``a`` is empty at the start of a text."""
        if len(self.neighbours) >= NEIGHBOURS:
            self.neighbours.clear()
        found = self.neighbours[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return found

    def _last(self, text: str, last: dict[int, str], done: int, end: int) -> str:
        """The last piece of ``text[:end]``; ``last`` keeps those found, by their ends, and has the one that ends at ``done``."""
        short = not done and end <= BEGINNING  # many words begin alike
        if short and (p := self.beginnings.get(text[:end])):
            last[end] = p
            return p
        node, found = self.back, [text[end - 1]]
        for c in text[max(done, end - self.longest) : end][::-1]:
            node = node.get(c)
            if node is None:
                break
            if "" in node:
                found.append(node[""])
        while True:
            p = found.pop()
            at = end - len(p)
            before = last[at] if at in last else self._last(text, last, done, at)
            stay = self.neighbours.get((before, p))
            if self._stay(before, p) if stay is None else stay:
                break
        last[end] = p
        if short:
            if len(self.beginnings) >= BEGINNINGS:
                self.beginnings.clear()
            self.beginnings[text[:end]] = p
        return p

    def stream_merged(self, text: str) -> Iterator[list[int]]:
        """Yields the ids that BPE merges leave of ``text`` as soon as they are certain.

        Of a text within the first window, only the beginnings that its own path asks for are looked at.
        """
        last, done, end, longest = {0: ""}, 0, 0, self.longest
        while end < len(text):
            before, end = end, min(len(text), end + max(longest, (end - done) // 2) if end else 2 * longest)
            if before or end < len(text) or end > DEPTH:
                for at in range(before + 1, end + 1):
                    if at not in last:
                        self._last(text, last, done, at)
            meet = end
            if end < len(text):
                live = set(range(max(done, end - longest + 1), end + 1))
                while len(live) > 1:  # follow the latest end back until all paths meet
                    at = max(live)
                    live.remove(at)
                    live.add(at - len(last[at]))
                meet = live.pop()
            if meet > done:
                pieces, at = [], meet
                while at > done:
                    p = last[at] if at in last else self._last(text, last, done, at)
                    pieces.append(p)
                    at -= len(p)
                pieces.reverse()
                yield self._ids(pieces)
                if meet < len(text):
                    for at in range(done, meet):
                        last.pop(at, None)
                done = meet

    def _ids(self, pieces: Iterable[str]) -> list[int]:
        ids: list[int] = []
        for p in pieces:
            if p in self.merges:
                ids.append(self.merges[p][1])
            else:
                ids += [self.byte_id[b] for b in p.encode()]
        return ids

    def _apart(self, chunk: str) -> list[str]:
        """``chunk`` cut where no piece of the vocabulary can run across."""
        inner = self.inner
        cuts = [k for k in range(1, len(chunk)) if chunk[k - 1 : k + 1] not in inner]
        return [chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True)] if cuts else [chunk]

    def search(self, text: str) -> Iterator[list[int]]:
        """Yields ids of ``text`` by the search of the model's type."""
        return self.stream_merged(text) if self.type == BPE else self.stream(text)

    def _search(self, part: str) -> bytes:
        ids = [i for some in self.search(part) for i in some]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes | None:
        """The ids of a word met before."""
        found = self.known.get(word)
        if found is None and (found := self.older.get(word)) is not None:
            self.known[word] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        if len(self.known) >= KNOWN:
            self.older, self.known = self.known, {}
        ids = self._word(chunk)
        if ids is None:
            parts = self._apart(chunk)
            found = []
            for part in parts:
                of_part = self._word(part) if len(parts) > 1 else None
                if of_part is None:
                    of_part = self._search(part)
                    if len(part) <= LONGEST_KNOWN:
                        self.known[part] = of_part
                found.append(of_part)
            ids = b"".join(found)
            if len(chunk) <= LONGEST_KNOWN:
                self.known[chunk] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian u32."""
        if not text:
            return b""
        marked = SPACE + text.replace(" ", SPACE)
        if not self.by_word:
            return b"".join(np.array(ids, "<u4").tobytes() for ids in self.search(marked))
        known, new = self.known.get, self._chunk
        return b"".join([known(c) or new(c) for c in _CHUNK.findall(marked)])

    def decode(self, ids: Iterable[int]) -> str:
        plain = self.plain
        text = b"".join([plain[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def pieces(model_file: str) -> Pieces:
    """The worker's vocabulary; it outlives a task."""
    return kept_in_worker(f"pieces of {model_file}", lambda: Pieces(model_file))


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids): little-endian u32 ids of each row of ``docs`` (doc_id, text).

    Every executor must be able to read ``model_file``.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model_file)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids = pa.array([vocabulary.encode(t) for t in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids, text): the texts of (doc_id, ids)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model_file)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                text = pa.array([vocabulary.decode(np.frombuffer(b or b"", "<u4").tolist()) for b in part.column(1).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), text], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids binary, text string")


def with_ids(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs`` with ids (little-endian u32), n_ids and round_trip, whether the ids decode to the text.

    Columns of these names are replaced.
    """
    rest = docs.drop("ids", "n_ids", "round_trip")
    at = rest.columns.index("text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model_file)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = part.column(at).to_pylist()
                ids = [vocabulary.encode(t) for t in texts]
                same = [vocabulary.decode(np.frombuffer(b, "<u4").tolist()) == (t or "") for b, t in zip(ids, texts, strict=True)]
                made = [pa.array(ids, pa.binary()), pa.array([len(b) // 4 for b in ids], pa.int64()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, "ids", "n_ids", "round_trip"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(encode, f"{fields}, ids binary, n_ids long, round_trip boolean")


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, round_trip) of each document: encoded, decoded and compared with its text."""
    return with_ids(docs.select("doc_id", "text"), model_file).select("doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"), "round_trip")


def op4_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op4_piece_ids": op4_piece_ids}
SQL: dict[str, str] = {}
