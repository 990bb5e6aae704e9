"""Shards of near equal bytes by a histogram sort.

Rows are ordered by a key whose leading part is a hash of the text, so that equal texts (a group) lie together, then by
id and place. Splitters between the shards are found without sorting: probes are laid through the open key ranges,
every task counts the exact bytes and rows of its keys between probes, and the summed counts narrow each splitter's
range until a probe lies within the tolerance of its target. First only probes between groups are tried. Where a
range shrinks to one group and neither of its edges is near enough, the splitter cuts the group, at an id or place
inside it. Then rows are exchanged once, straight to the partition their key belongs to; the counts below the
splitters also give the first slot of each partition, so slots need no further pass.

Scale: a pass reads only the key and size columns and returns as many rows a task as there are open ranges times
probes; the driver holds the splitters (a shard is cut into ranges of ``RANGE_BYTES``, one task each) and the counts
between probes, never keys of rows. A group that holds a third of all rows is spread over several shards and tasks;
groups of up to twice the tolerance of a shard's share are never cut.

Defined results: bytes of a row are its UTF-8 bytes, none for a null text, plus ``overhead``; null texts are one group.
An id may be null (first in its group) and may repeat: equal rows are ordered by the place that the staged table gives
them. Integer ids are ordered by value, others by a hash of their text. A splitter lies within the tolerance of its
target, or at the row edge nearest to it if one row is larger than that, so a shard can be empty beside a giant row. An
empty table gives an empty result. Other columns are kept, but for those named like the result's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersync.llm.common import stage, table

GROUP, REST = 8, 17  # bytes of a key: the hash of the text; null flag and id, place
WIDTH = GROUP + REST
RANGE_BYTES = 256 << 20  # of a partition of the exchange
PROBES = 4_096  # laid in one pass, 3 for each open splitter at least


def _key(doc_id: str, kind: str) -> Column:
    """The order of rows as bytes: group, id with nulls first, place."""
    number = f"CAST({doc_id} AS BIGINT)" if kind in ("tinyint", "smallint", "int", "bigint") else f"xxhash64(CAST({doc_id} AS STRING))"
    flipped = f"lpad(hex({number} ^ CAST(-9223372036854775808 AS BIGINT)), 16, '0')"  # two's complement in unsigned order
    return F.expr(
        "unhex(concat(coalesce(substr(md5(CAST(text AS BINARY)), 1, 16), repeat('0', 16)), "
        f"CASE WHEN {doc_id} IS NULL THEN repeat('0', 18) ELSE concat('01', {flipped}) END, lpad(hex(_place), 16, '0')))"
    )


def _keys(column: pa.Array) -> np.ndarray:
    """Keys of fixed width as numpy strings of bytes, which compare like unsigned numbers."""
    column = column.cast(pa.binary())
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else np.zeros(0, np.uint8)
    start = column.offset * WIDTH  # every value has the same width
    return data[start : start + len(column) * WIDTH].view(f"S{WIDTH}")


def _as_bytes(keys: list[int]) -> np.ndarray:
    return np.array([k.to_bytes(WIDTH, "big") for k in keys], f"S{WIDTH}")


def _counted(probes: np.ndarray, open_: np.ndarray):
    """Bytes and rows between neighbouring probes, and the least and greatest key there, for the open intervals."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(open_), np.int64), np.zeros(len(open_), np.int64)
        low, high = np.full(len(open_), b"\xff" * WIDTH, f"S{WIDTH}"), np.zeros(len(open_), f"S{WIDTH}")
        for batch in batches:
            keys, sizes = _keys(batch.column(0)), batch.column(1).to_numpy()
            at = np.searchsorted(probes, keys, "right")
            order = np.flatnonzero(open_[at])
            order = order[np.argsort(keys[order])]
            if not len(order):
                continue
            keys, sizes, at = keys[order], sizes[order], at[order]
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            last, hit = np.r_[first[1:], len(at)] - 1, at[first]
            size[hit] += np.add.reduceat(sizes, first)
            rows[hit] += last - first + 1
            low[hit] = np.where(keys[first] < low[hit], keys[first], low[hit])
            high[hit] = np.where(keys[last] > high[hit], keys[last], high[hit])
        hit = np.flatnonzero(rows)
        whole = lambda x: pa.array([k.ljust(WIDTH, b"\0") for k in x[hit].tolist()], pa.binary())  # noqa: E731  numpy drops zeros at the end
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(size[hit]), pa.array(rows[hit]), whole(low), whole(high)], ["at", "size", "n", "low", "high"])

    return count


Edge = tuple[int, int, int]  # a key, with the bytes and rows of all keys below it


class Search:
    """The search for one splitter, between two edges around its target."""

    def __init__(self, target: int, tolerance: float, total: tuple[int, int]) -> None:
        self.target, self.tolerance = target, tolerance
        self.low, self.high = (0, 0, 0), (1 << 8 * WIDTH, *total)
        self.unit = 1 << 8 * REST  # only keys that begin a group, until one group is left
        self.found: Edge | None = None

    def probes(self, n: int) -> list[int]:
        """Up to ``n`` keys that divide what is open."""
        first, last = self.low[0] // self.unit + 1, self.high[0] // self.unit - 1
        if last - first < n:
            return [k * self.unit for k in range(first, last + 1)]
        return [(first + (last - first) * i // (n - 1)) * self.unit for i in range(n)]

    def narrow(self, intervals: list[tuple[Edge, Edge, tuple[int, int] | None]]) -> None:
        """``intervals`` between neighbouring probes: both edges, and the least and greatest key between them."""
        best = min((e for i in intervals for e in i[:2]), key=lambda e: (abs(e[1] - self.target), e[0]))
        if abs(best[1] - self.target) <= self.tolerance:
            self.found = best
            return
        low, high, (least, most) = next(i for i in intervals if i[0][1] <= self.target < i[1][1])
        if least // self.unit == most // self.unit:  # a single group, whose edges are too far; or a single row
            if self.unit == 1:
                self.found = best
            self.unit = 1
        # keys near the rows themselves: nothing lies between the old edges and these
        self.low = (least // self.unit * self.unit, *low[1:])
        self.high = ((most // self.unit + 1) * self.unit, *high[1:])


def splitters(keys: DataFrame, targets: list[tuple[int, float]], total: tuple[int, int]) -> list[Edge]:
    """An edge near each of ``targets`` (bytes below, tolerance), ascending; ``keys`` has (key, size) for every row."""
    searches = [Search(target, tolerance, total) for target, tolerance in targets]
    while waiting := [s for s in searches if s.found is None]:
        laid = [s.probes(max(4, PROBES // len(waiting))) for s in waiting]
        ends = {e[0]: e[1:] for s in waiting for e in (s.low, s.high)}
        probes = sorted({k for ps in laid for k in ps} | {k for k in ends})
        at = {k: i for i, k in enumerate(probes)}
        open_ = np.zeros(len(probes) + 1, bool)
        for s in waiting:
            open_[at[s.low[0]] + 1 : at[s.high[0]] + 1] = True
        inner = _as_bytes([k for k in probes if k < 1 << 8 * WIDTH])
        counted = keys.mapInArrow(_counted(inner, open_), "at long, size long, n long, low binary, high binary")
        sums = counted.groupBy("at").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        found = {r["at"]: r for r in sums.collect()}  # one row for each open interval at most
        for s in waiting:
            intervals, below = [], s.low
            for i in range(at[s.low[0]], at[s.high[0]]):
                r = found.get(i + 1)
                if r:
                    edge = (probes[i + 1], below[1] + r["size"], below[2] + r["n"])
                    intervals.append((below, edge, (int.from_bytes(r["low"], "big"), int.from_bytes(r["high"], "big"))))
                    below = edge
                else:
                    below = (probes[i + 1], *below[1:])
            s.narrow(intervals)
    return [s.found for s in searches]


def _placed(edges: list[Edge], shard_of: list[int], base_of: list[int]):
    """Number of the range, shard and first slot of each key."""
    starts = _as_bytes([e[0] for e in edges if e[0] < 1 << 8 * WIDTH])
    shards, bases = np.array(shard_of, np.int32), np.array(base_of, np.int64)

    @F.arrow_udf("struct<range:int,shard:int,base:long>")
    def place(key: pa.Array) -> pa.Array:
        at = np.searchsorted(starts, _keys(key), "right")
        return pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(shards[at]), pa.array(bases[at])], ["range", "shard", "base"])

    return place


_RESULT = ("size", "text_crc32", "shard", "slot")


def shards_by_bytes(docs: DataFrame, n_shards: int = 24, doc_id: str = "doc_id", tolerance: float = 0.01, overhead: int = 8) -> DataFrame:
    """All rows of ``docs`` with (size, text_crc32, shard, slot), one range of the key in each partition, in its order."""
    bytes_ = F.col("text").cast("binary")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(overhead)).cast("long")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    placed = docs.select(row.alias("row"), F.col(doc_id).alias("_id"), "text", F.monotonically_increasing_id().alias("_place"))
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    crc = F.coalesce(F.crc32(bytes_), F.lit(0)).cast("long")
    staged = stage(placed.select("row", _key("_id", kind).alias("key"), size.alias("size"), crc.alias("text_crc32")), "shards-rows")
    total = staged.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count("*").alias("n")).first()
    parts = max(1, -(-total["size"] // (n_shards * RANGE_BYTES)))
    n_ranges, width = n_shards * parts, total["size"] / (n_shards * parts)
    # a shard's edge within the tolerance of its share; the edges of ranges inside it need not be as near
    near = [min(tolerance * width * parts, width / 4) if i % parts == 0 else width / 4 for i in range(1, n_ranges)]
    targets = [(total["size"] * i // n_ranges, t) for i, t in enumerate(near, 1)]
    edges = splitters(staged.select("key", "size"), targets, (total["size"], total["n"])) if total["n"] else []
    below = [0, *[e[2] for e in edges]]
    shard_of = [i // parts for i in range(len(below))]
    to = _placed(edges, shard_of, [n - below[s * parts] for n, s in zip(below, shard_of, strict=True)])
    laid = staged.withColumn("to", to("key")).repartitionById(n_ranges, F.col("to.range")).sortWithinPartitions("to.shard", "key")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # of the row in its partition
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in _RESULT]
    return laid.select(*kept, "size", "text_crc32", F.col("to.shard").alias("shard"), (F.col("to.base") + position).alias("slot"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Parquet files in ``path``/shard=N, each one a run of the shard's slots."""
    shards_by_bytes(docs, **options).write.partitionBy("shard").parquet(path)


def op13_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shards_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op13_byte_shards": op13_byte_shards}
SQL: dict[str, str] = {}
