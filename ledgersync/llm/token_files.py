"""Token ids in files, entropy-coded by a static range asymmetric numeral system.

Documents are put in order of their id by a range partitioning and tokenised there. Each task cuts its part into
segments of some two million ids. A segment holds one frequency table, shared by its blocks, and blocks of equally many
ids that are coded on their own: 64 interleaved states a block write one stream of 32-bit words. The states and the
word offset at every 256th step are stored as checkpoints, so that all stretches between them decode side by side (here:
as lanes of the same array operations), and every block has a checksum that reading verifies.

File format (``SEGMENT``), one row per segment in Parquet files that Spark writes and reads:
shard, segment int - place in the order of ids; first long - ids of the shard before the segment;
doc_ids, lengths array<long> - the documents and their numbers of ids; data binary, little-endian:
 magic ``RIDS``; u32 scale bits, lanes, steps, interval, blocks, table bytes, words; u64 ids;
 table: zlib of K u32 symbols and K u32 frequencies (sum 2**scale bits);
 per block: u32 crc32 of its ids as u32; per block and checkpoint: u32 word offset in the segment;
 per block, checkpoint and lane: u64 state; u32 words.
Id ``block * lanes * steps + step * lanes + lane`` belongs to that block, step and lane; the last ones may be padding.

Scale: one shuffle of the texts, then map-only work on one segment at a time. Words are looked up in a bounded table of
words that the worker has encoded before; the vocabulary drops white space, so a text's ids are those of its words in
turn. Positions over all shards come from one total per shard.

Defined results: a null text is empty and has the end id alone; a null id comes first; rows with the same id stand side
by side, in order of a hash of their texts, and may fill several shards; a text of any length is one document, which grows its segment; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.llm.common import table
from ledgersync.session import scratch_path

SCALE = 18
LANES = 64
BLOCK = 1 << 16
INTERVAL = 256
SEGMENT_IDS = 1 << 21
KNOWN_WORDS, KNOWN_PARTS = 800_000, 800_000  # entries of a worker's tables of words, and of words apart from their marks
SEGMENT = "shard int, segment int, first long, doc_ids array<long>, lengths array<long>, data binary"
_HEAD = "<4s7IQ"
_LOW, _WORD = np.uint64(1 << 31), np.uint64(32)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols present and their frequencies, each at least 1, summing to 2**SCALE."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    if len(symbols) > 1 << SCALE:
        raise ValueError("more distinct ids than the frequency scale can hold")
    f = 1 + counts[symbols] * ((1 << SCALE) - len(symbols)) // counts.sum()
    f[np.argmax(f)] += (1 << SCALE) - f.sum()
    return symbols, f


def encode_segment(ids: np.ndarray) -> bytes:
    """``ids`` (not empty) as a segment's data."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    steps = -(-n // (blocks * LANES))
    symbols, freq = frequencies(ids)
    dense = np.zeros(symbols[-1] + 1, np.int64)
    dense[symbols] = np.arange(len(symbols))
    start = np.cumsum(freq) - freq
    padded = np.full(blocks * steps * LANES, symbols[np.argmax(freq)], np.int64)
    padded[:n] = ids
    rows = dense[padded].reshape(blocks, steps, LANES)
    f, c = freq.astype(np.uint64), start.astype(np.uint64)
    state = np.full((blocks, LANES), _LOW, np.uint64)
    out = np.zeros((blocks, steps, LANES), np.uint32)
    written = np.zeros((blocks, steps, LANES), bool)
    marks = range(0, steps, INTERVAL)
    states = np.zeros((blocks, len(marks), LANES), np.uint64)
    room = np.uint64(63 - SCALE)
    for t in range(steps - 1, -1, -1):
        s = rows[:, t]
        fs = f[s]
        full = state >= fs << room
        out[:, t] = state
        written[:, t] = full
        state = np.where(full, state >> _WORD, state)
        q = state // fs
        state = (q << np.uint64(SCALE)) + (state - q * fs) + c[s]
        if t % INTERVAL == 0:
            states[:, t // INTERVAL] = state
    words = out[written]
    per_step = written.sum(axis=2).ravel()
    offsets = (np.cumsum(per_step) - per_step).reshape(blocks, steps)[:, ::INTERVAL]
    crcs = [zlib.crc32(padded[b * steps * LANES : (b + 1) * steps * LANES].astype("<u4").tobytes()) for b in range(blocks)]
    packed = zlib.compress(symbols.astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6)
    head = struct.pack(_HEAD, b"RIDS", SCALE, LANES, steps, INTERVAL, blocks, len(packed), len(words), n)
    parts = (np.array(crcs, "<u4"), offsets.astype("<u4"), states.astype("<u8"), words.astype("<u4"))
    return b"".join([head, packed, *(p.tobytes() for p in parts)])


def decode_segment(data: bytes) -> np.ndarray:
    """The ids of a segment; a damaged one is an error."""
    magic, scale, lanes, steps, interval, blocks, packed, n_words, n = struct.unpack_from(_HEAD, data)
    if magic != b"RIDS":
        raise ValueError("not a token segment")
    at = struct.calcsize(_HEAD)
    pairs = np.frombuffer(zlib.decompress(data[at : at + packed]), "<u4").reshape(2, -1)
    at += packed
    marks = -(-steps // interval)

    def take(kind: str, *shape: int) -> np.ndarray:
        nonlocal at
        x = np.frombuffer(data, kind, int(np.prod(shape)), at).reshape(shape)
        at += x.nbytes
        return x

    crcs, offsets = take("<u4", blocks), take("<u4", blocks, marks)
    state = take("<u8", blocks, marks, lanes).reshape(-1, lanes).copy()
    words = np.append(take("<u4", n_words), np.uint32(0)).astype(np.uint64)
    symbols, freq = pairs
    slot = np.repeat(np.arange(len(symbols)), freq)
    f, c = freq.astype(np.uint64), (np.cumsum(freq, dtype=np.uint64) - freq)
    here = offsets.ravel().astype(np.int64)
    out = np.zeros((blocks, marks * interval, lanes), np.uint32)
    by_mark = out.reshape(blocks * marks, interval, lanes)
    live = np.minimum(steps - np.tile(np.arange(marks) * interval, blocks), interval)
    mask = np.uint64((1 << scale) - 1)
    for t in range(min(steps, interval)):
        low = state & mask
        s = slot[low]
        by_mark[:, t] = symbols[s]
        state = f[s] * (state >> np.uint64(scale)) + low - c[s]
        short = state < _LOW
        short[live <= t] = False
        place = np.where(short, np.minimum(here[:, None] + np.cumsum(short, axis=1) - 1, n_words), n_words)  # damaged data stays in range
        state = np.where(short, (state << _WORD) | words[place], state)
        here = here + short.sum(axis=1)
    ids = out[:, :steps].reshape(blocks, -1)
    for b in range(blocks):
        if zlib.crc32(ids[b].astype("<u4").tobytes()) != crcs[b]:
            raise ValueError(f"checksum of block {b} differs")
    return ids.ravel()[:n]


# Parts of a lower-cased word. Plain Latin letters (a-z and U+00E0..U+00FF but the division sign, and their capitals) up to
# an ASCII character that is neither letter nor apostrophe, or else everything up to white space.
_LETTERS = rb"[a-z\xc3\x80-\x96\x98-\xb6\xb8-\xbf]++(?=[\x00-\x26\x28-\x40\x5b-\x60\x7b-\x7f]|\Z)"
_PLAIN = re.compile(_LETTERS)
_LATIN = [*range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]
# characters that stand for bytes in vocabularies of bytes: themselves where they are visible, others in turn from U+0100
_SEEN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_FOR_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SEEN)}


class _Table(dict):
    """Ids of words; those of a missing one are found and kept."""

    def __init__(self, find: Callable[[bytes], bytes]) -> None:
        self.find = find

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = self.find(word)
        return found


class WordEncoder:
    """Ids of texts under a vocabulary that never joins what ASCII white space separates, and lower-cases.

    Words are looked up whole. Letters and the marks or digits behind them are separate to the vocabulary too, so an
    unknown word is put together from its parts, of which far fewer are new. Letters go to the merges directly, where the
    vocabulary is one of bytes, without the search for words in a text.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        sample = [chr(c) for c in _LATIN]
        sample = [w.encode() for w in (*sample, "".join(sample), *map("".join, zip(sample, sample[26:], strict=False)))]
        direct = all(self._letters(w) == self._text(w) for w in sample)
        self.parts = _Table(self._letters if direct else self._text)
        self.known = _Table(self._word)

    def _text(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _letters(self, word: bytes) -> bytes:
        text = word.decode()
        if not word.isascii():
            text = text.lower().encode().decode("latin-1").translate(_FOR_BYTES)
        ids = [token.id for token in self.merge(text)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _rest(self, rest: bytes) -> bytes:
        found = self.parts.get(rest)
        if found is None:
            found = self.parts[rest] = self._text(rest)
        return found

    def _word(self, word: bytes) -> bytes:
        letters = _PLAIN.match(word)
        if letters is None:
            return self._rest(word)
        end = letters.end()
        return self.parts[word] if end == len(word) else self.parts[word[:end]] + self._rest(word[end:])

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        """Each text's ids as little-endian u32."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        if len(self.parts) > KNOWN_PARTS:
            self.parts.clear()
        known = self.known.__getitem__
        return [b"".join(map(known, (t or b"").lower().split())) for t in texts]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """The worker's encoder; it outlives a task, as does its table of words."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _write(path: str, end_id: int):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = _encoder(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        number, first, held, doc_ids, lengths = 0, 0, [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal number, first, held, doc_ids, lengths
            ids = np.frombuffer(b"".join(held), "<u4")
            row = [[shard], [number], [first], [doc_ids], [lengths], [encode_segment(ids)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["shard", "segment", "first", "doc_ids", "lengths", "data"]
            made = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names)
            number, first, held, doc_ids, lengths = number + 1, first + len(ids), [], [], []
            return made

        size = 0
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for lo in range(0, len(keys), 256):
                for key, ids in zip(keys[lo : lo + 256], encode(texts[lo : lo + 256].to_pylist()), strict=True):
                    held += [ids, end]
                    doc_ids.append(key)
                    lengths.append(len(ids) // 4 + 1)
                    size += lengths[-1]
                    if size >= SEGMENT_IDS:
                        yield flush()
                        size = 0
        if doc_ids:
            yield flush()

    return segments


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1) -> None:
    """Write the ids of ``docs`` (doc_id, text) in ascending order of doc_id.

    ``vocabulary`` is a file of the tokenizers library that every executor can read.
    """
    order = [F.col("doc_id"), F.xxhash64("text")]  # rows of one id may lie in several shards
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(_write(vocabulary, end_id), SEGMENT).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, doc_id, offset, ids): the documents' ids as little-endian u32, with their offset in the shard."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("shard", "first", "doc_ids", "lengths", "data")}
                ids = decode_segment(row["data"]).astype("<u4").tobytes()
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(ends), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["first"], pa.int64()),
                        pa.array([ids[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)], pa.binary()),
                    ],
                    ["shard", "doc_id", "offset", "ids"],
                )

    return spark.read.schema(SEGMENT).parquet(path).mapInArrow(decode, "shard int, doc_id long, offset long, ids binary")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    totals = spark.read.schema(SEGMENT).parquet(path).groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per shard
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    docs = read_token_files(spark, path).select(
        "shard", "doc_id", "offset", F.expr("length(ids) div 4").cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
    return docs.join(bases, "shard").select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


QUERIES = {"op9_token_files": op9_token_files}
SQL: dict[str, str] = {}
