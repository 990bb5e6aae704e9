"""Near-duplicate documents: an exact Jaccard join of word shingles through count-vector trees.

A document is the set of its shingles, hashed to 64 bits. Equal sets are one class. A class's shingles are dealt by hash
into ``GROUPS`` groups, and the counts per group are a point. The overlap of two sets is at most the sum over the groups
of the smaller count, so a pair within the similarity is found among the pairs whose bound, with their sizes, allows it;
only those are compared shingle by shingle.

Points meet where they share a shingle among their first ones in a common order of all shingles: a pair at similarity t
shares one among the first n - ceil(t n) + 1 of each. The order puts shingles that many documents share last, so passages
found everywhere bring nobody together. The points that meet at a shingle form a cell. First each point of
a cell is compared with the cell's least point, which joins groups of copies by single links; a second turn takes other
pivots where a cell of three points and more holds several components. What such cells still hold is compared in full: their points are packed by size into leaves of bounded length,
with the greatest count of each group as the leaf's box, and leaf meets leaf where boxes and sizes allow; inside, pairs of
different components are bounded by summed minima, by those of a finer vector of ``FINE`` groups, then verified. Pairs
inside a component need no look: the result are components, not links. Near copies share most of their cells, so each point
carries the first ``MEETS`` of its cells, and a pair is left to the first of those it has in common. Two components take the
``BEST`` pairs of each look at some leaves; the cells where more were held back are looked at once more, without that bound,
when the links found have joined most of them.

Scale: every stage is a join, a grouping with partial sums, or a window over (shingle, id) rows that spills; no list of
a cell's points is ever built beyond a leaf. Texts are shuffled only for classes in surviving pairs and a few others that
an id filter of bounded size lets through. Links of a group of k copies number about k, not k * k. Components come from
alternating star steps.

Defined results: null, blank and wordless texts have no shingles and link with nothing; fewer words than a shingle make
one shingle of all; repeated rows and repeated ids are documents of their own (a repeated id takes part in each of its
rows' components; rows of one id are not linked by it); a null id is the smallest id only where no other is there; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.llm.common import components, forget_kept, stage, table
from ledgersync.operators.bitmaps import key_bitmaps, mark_members

GROUPS = 48
LEAF = 128  # points of a leaf
FINE = 512  # groups of the finer vector, in bytes, that bounds the pairs left once more
PAIRS, FINE_PAIRS = 1 << 17, 1 << 13  # pairs bounded at a time
KNOWN_WORDS = 400_000
FILTER_BITS, MOST_FILTER_BITS = 64, 1 << 29  # for each wanted id, and in all (64 MB)
SENT = 1 << 17  # pairs a task remembers, so as to send them once
MEETS = 8  # cells, the first of its own, that a point carries
BEST = 4  # pairs of two components that are verified before the others
PIVOTS = 32  # different pivots that cells with much the same points take in the second turn
COMMON = 1 / 500  # share of all documents from which a shingle is common


class Shingles:
    """Hashes texts to their sets of shingles."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.known: dict[bytes, bytes] = {}
        self.factors = (np.random.default_rng(7).integers(1, 1 << 62, width, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Each text's distinct shingles, sorted."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known, out = self.known, []
        for t in texts:
            words = (t or b"").lower().split()
            found = list(map(known.get, words))
            if None in found:
                for k, w in enumerate(words):
                    if found[k] is None:
                        found[k] = known[w] = xxhash.xxh3_64_digest(w)
            out.append(self._set(np.frombuffer(b"".join(found), "<u8").astype(np.uint64)))
        return out

    def _set(self, h: np.ndarray) -> np.ndarray:
        if not len(h):
            return h
        k = min(self.width, len(h))
        with np.errstate(over="ignore"):
            x = np.full(len(h) - k + 1, np.uint64(k if len(h) < self.width else 0))
            for i in range(k):
                x += h[i : len(h) - k + 1 + i] * self.factors[i]
            # spread the bits: order and groups are taken from them
            x ^= x >> np.uint64(33)
            x *= np.uint64(0xFF51AFD7ED558CCD)
            x ^= x >> np.uint64(33)
            x *= np.uint64(0xC4CEB9FE1A85EC53)
            x ^= x >> np.uint64(33)
        return np.unique(x)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of the batches, whose column ``text`` is read, with the sets of their texts."""
    forget_kept()
    hash_text = Shingles(width)
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            yield part, hash_text(part.column("text").cast(pa.binary()).to_pylist())


_POINTS = "doc_id long, n long, low long, mix long, counts array<int>, fine binary, shingle long, times long"


def _fine(sets: list[np.ndarray]) -> list[bytes]:
    """The finer count vectors; all bytes 255, which bound nothing, where a count passes a byte."""
    made = [np.bincount((s >> np.uint64(55)).astype(np.int64), minlength=FINE) for s in sets]
    return [(f if f.max(initial=0) < 255 else np.full(FINE, 255)).astype(np.uint8).tobytes() for f in made]


def _fine_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Most shingles that sets with these vectors can share, row by row."""
    found = np.minimum(a, b).sum(axis=1, dtype=np.int64)
    return np.where(found == 255 * FINE, np.iinfo(np.int32).max, found)


def _rows_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, FINE)


def _points(width: int):
    """Documents as points: size, two digests of the set, and the counts of both kinds of groups; and, in rows of their own,
    shingles that more than one document of a part has, with the number of those documents."""

    def points(batches):
        for part, sets in _sets(batches, width):
            low = [int(s.sum(dtype=np.uint64)) for s in sets]
            with np.errstate(over="ignore"):
                mix = [int((s * (s >> np.uint64(31) | np.uint64(1))).sum(dtype=np.uint64)) for s in sets]
            counts = [np.bincount((s % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS) for s in sets]
            value, times = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
            value, times = value[times > 1].view(np.int64), times[times > 1]
            here, more = len(sets), len(value)
            columns = [
                pa.concat_arrays([part.column("doc_id"), pa.nulls(more, pa.int64())]),
                pa.array([len(s) for s in sets] + [None] * more, pa.int64()),
                *[pa.concat_arrays([pa.array(np.array(x, np.uint64).view(np.int64)), pa.nulls(more, pa.int64())]) for x in (low, mix)],
                pa.array(counts + [None] * more, pa.list_(pa.int32())),
                pa.array(_fine(sets) + [None] * more, pa.binary()),
                *[pa.concat_arrays([pa.nulls(here, pa.int64()), pa.array(x, pa.int64())]) for x in (value, times)],
            ]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _POINTS.split(", ")])

    return points


def _common(points: DataFrame, documents: int) -> np.ndarray:
    """Shingles that at least one in ``1 / COMMON`` of all documents share, as far as parts of them show it.

    They are counted over all documents; their number is at most the mean size of a set over COMMON. The list does no
    more than order shingles: any list gives the same links.
    """
    found = points.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times"))
    rows = found.where(F.col("times") >= max(8.0, documents * COMMON)).select("shingle").toPandas()
    return np.sort(rows["shingle"].to_numpy(np.int64).view(np.uint64))


def _first(width: int, similarity: float, common: np.ndarray):
    """(key, low): the first shingles of each set, common ones last, and the set's digest."""

    def first(batches):
        for _, sets in _sets(batches, width):
            keys, low = [], []
            for s in sets:
                n = len(s)
                if not n:
                    continue
                take = n - ceil(similarity * n - 1e-9) + 1
                if len(common):
                    known = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
                    s_ordered = np.concatenate([s[~known], s[known]]) if known.any() else s
                else:
                    s_ordered = s
                keys.append(s_ordered[:take])
                low.append(np.full(take, s.sum(dtype=np.uint64)))
            if keys:
                columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (keys, low)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "low"])

    return first


def _allows(similarity: float, overlap: str, n_a: str, n_b: str) -> str:
    return f"(1 + {similarity}D) * ({overlap}) >= {similarity}D * ({n_a} + {n_b}) - 1e-9"


def _minima(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (x, y) -> least(x, y)), 0L, (s, x) -> s + x)"


def _bounded(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """(a, b) from pairs of digests: the pairs of classes whose sizes and summed minima allow the similarity."""
    side = lambda x: classes.select(F.col("low").alias(f"low_{x}"), F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("counts").alias(f"v_{x}"))
    sized = pairs.join(side("a"), "low_a").join(side("b"), "low_b")
    sized = sized.where(_allows(similarity, "least(n_a, n_b)", "n_a", "n_b")).where(_allows(similarity, _minima("v_a", "v_b"), "n_a", "n_b"))
    return sized.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _perhaps_listed(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids`` and a few others, so that the join after it moves few texts.

    Ids are hashed to bits, ``FILTER_BITS`` for each listed one but ``MOST_FILTER_BITS`` in all, which bounds what is broadcast.
    """
    bits = min(MOST_FILTER_BITS, FILTER_BITS * max(n, 1))
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    maps = stage(key_bitmaps(ids.select(bit("id").alias("bit")), "bit"), "id-bits")
    return mark_members(docs.withColumn("bit", bit("doc_id")), "bit", maps, "listed").where("listed").drop("bit", "listed")


def _sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, set) of the classes named in ``nodes``: the sorted shingles."""
    wanted = stage(classes.select("node", "doc_id", "n", "low").join(nodes, "node").withColumnRenamed("doc_id", "id"), "wanted")

    def sets(batches):
        seen: set[int] = set()  # a class once where rows repeat; a repetition in another task is only read twice
        for part, found in _sets(batches, width):
            hit = []
            for s, node, n, low in zip(found, *(part.column(c).to_pylist() for c in ("node", "n", "low")), strict=True):
                # of rows with the same id, those that are the class
                hit.append(node not in seen and len(s) == n and int(s.sum(dtype=np.uint64).view(np.int64)) == low)
                if hit[-1]:
                    seen.add(node)
            made = pa.array([s.astype("<u8").tobytes() for s in found], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("node"), made], ["node", "set"]).filter(pa.array(hit, pa.bool_()))

    some = _perhaps_listed(docs, wanted.select("id"), wanted.count())
    texts = some.join(wanted, F.col("doc_id").eqNullSafe(F.col("id"))).select("node", "n", "low", "text")
    return stage(texts.mapInArrow(sets, "node long, set binary"), "shingle-sets")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _refined(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that the finer vectors allow."""

    def refine(batches):
        for batch in batches:
            hit = np.zeros(batch.num_rows, bool)
            for lo in range(0, batch.num_rows, FINE_PAIRS):
                part = batch.slice(lo, FINE_PAIRS)
                overlap = _fine_overlap(_rows_of(part.column("fine_a")), _rows_of(part.column("fine_b")))
                hit[lo : lo + FINE_PAIRS] = (1 + similarity) * overlap >= similarity * part.column("m").to_numpy() - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(hit))

    side = lambda x: classes.select(F.col("node").alias(x), F.col("fine").alias(f"fine_{x}"), F.col("n").alias(f"n_{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("m", F.col("n_a") + F.col("n_b"))
    return sized.select("a", "b", "fine_a", "fine_b", "m").mapInArrow(refine, "a long, b long")


def _verified(pairs: DataFrame, made: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""

    def compare(batches):
        for batch in batches:
            hit = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                both = len(np.intersect1d(s, t, assume_unique=True))
                hit.append((1 + similarity) * both >= similarity * (len(s) + len(t)) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    part = lambda x: made.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))
    return stage(pairs.join(part("a"), "a").join(part("b"), "b").mapInArrow(compare, "a long, b long"), "shingle-links")


def _met_before(meets_a: np.ndarray, meets_b: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether two points share one of the cells they carry that comes before the cell ``key``, row by row."""
    before = np.where(meets_a < key[:, None], meets_a, np.iinfo(np.int64).max)  # no cell that is before the key has that one
    return ((before[:, :, None] == meets_b[:, None, :]) & (before < key[:, None])[:, :, None]).any(axis=(1, 2))


def _beyond(x: np.ndarray, y: np.ndarray, worth: np.ndarray, most: int) -> np.ndarray:
    """Which pairs come after the ``most`` worthiest of the same two components (x, y)."""
    low, high = np.minimum(x, y), np.maximum(x, y)
    order = np.lexsort((-worth, high, low))
    low, high = low[order], high[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    at = np.arange(len(low))
    out = np.zeros(len(low), bool)
    out[order] = at - np.maximum.accumulate(np.where(new, at, 0)) >= most
    return out


def _leaf_pairs(similarity: float, most: int | None = None):
    """Pairs of two leaves' points of different components that sizes and summed minima allow and no earlier cell holds.

    With ``most``, of those that two components have in one look only the pairs with the highest bounds; where others were
    held back, the cell follows in a row of its own, (key, null).
    """

    def lists(batch: pa.RecordBatch, side: str) -> tuple[np.ndarray, ...]:
        start = batch.column(f"low_{side}").offsets.to_numpy().astype(np.int64)
        flat = [batch.column(f"{c}_{side}").flatten().to_numpy(zero_copy_only=False) for c in ("low", "n", "component", "counts", "meets")]
        return start[:-1] - start[0], np.diff(start), *flat[:3], flat[3].reshape(-1, GROUPS), _rows_of(batch.column(f"fine_{side}").flatten()), flat[4].reshape(-1, MEETS)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = np.zeros((0, 2), np.int64)  # pairs handed over lately, which other cells of the task may hold as well
        for batch in batches:
            if not batch.num_rows:
                continue
            start_a, len_a, low_a, n_a, group_a, counts_a, fine_a, meets_a = lists(batch, "a")
            start_b, len_b, low_b, n_b, group_b, counts_b, fine_b, meets_b = lists(batch, "b")
            same, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("same", "key"))
            until = np.cumsum(len_a * len_b)
            lo = 0
            while lo < len(until):  # as many leaf pairs as stay within PAIRS, one at least
                before = until[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(until, before + PAIRS, side="right")))
                total = until[lo:hi] - before
                row = lo + np.repeat(np.arange(hi - lo), len_a[lo:hi] * len_b[lo:hi])
                at = np.arange(total[-1]) - np.repeat(np.r_[0, total[:-1]], len_a[lo:hi] * len_b[lo:hi])
                i, j = start_a[row] + at // len_b[row], start_b[row] + at % len_b[row]
                n, m = n_a[i], n_b[j]
                hit = (group_a[i] != group_b[j]) & (np.minimum(n, m) * (1 + similarity) >= similarity * (n + m) - 1e-9) & (~same[row] | (low_a[i] < low_b[j]))
                i, j, row = i[hit], j[hit], row[hit]
                overlap = np.minimum(counts_a[i], counts_b[j]).sum(axis=1)
                hit = (1 + similarity) * overlap >= similarity * (n_a[i] + n_b[j]) - 1e-9
                i, j, row = i[hit], j[hit], row[hit]
                hit, worth = np.zeros(len(i), bool), np.zeros(len(i))
                for at in range(0, len(i), FINE_PAIRS):
                    part = slice(at, at + FINE_PAIRS)
                    part = at + np.flatnonzero(~_met_before(meets_a[i[part]], meets_b[j[part]], key[row[part]]))
                    x, y = i[part], j[part]
                    overlap, both = _fine_overlap(fine_a[x], fine_b[y]), n_a[x] + n_b[y]
                    hit[part] = (1 + similarity) * overlap >= similarity * both - 1e-9
                    worth[part] = overlap / both
                i, j, row, worth = i[hit], j[hit], row[hit], worth[hit]
                held = np.zeros(0, np.int64)
                if most is not None:
                    beyond = _beyond(group_a[i], group_b[j], worth, most)
                    held = np.unique(key[row[beyond]])
                    i, j = i[~beyond], j[~beyond]
                found = np.unique(np.sort(np.stack([low_a[i], low_b[j]], axis=1), axis=1), axis=0)
                both, first = np.unique(np.concatenate([sent, found]), axis=0, return_index=True)
                fresh = both[first >= len(sent)]
                sent = both if len(both) <= SENT else np.zeros((0, 2), np.int64)
                made = [pa.array(np.r_[fresh[:, 0], held]), pa.concat_arrays([pa.array(fresh[:, 1]), pa.nulls(len(held), pa.int64())])]
                yield pa.RecordBatch.from_arrays(made, ["low_a", "low_b"])
                lo = hi

    return pairs


def _mixed(cells: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """(key, low, component) of the cells that hold several components, once where cells hold the same points.

    In a cell of two points the first star has met the only pair.
    """
    component = F.coalesce("component", "node").alias("component")
    labelled = stage(cells.select("key", "low").join(classes.join(found, "node", "left").select("low", component), "low"), "labelled-cells")
    digests = [F.sum(F.xxhash64("low", F.lit(k)).cast("decimal(38,0)")).alias(f"d{k}") for k in (1, 2)]
    held = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("points"), *digests)
    kept = held.where("x < y AND points > 2").groupBy("points", "d1", "d2").agg(F.min("key").alias("key"))
    return stage(labelled.join(kept.select("key"), "key"), "mixed-cells")


def _stars(cells: DataFrame) -> DataFrame:
    """(low_a, low_b): the points of each cell with its pivot, where their components differ.

    Cells that hold much the same points take up to ``PIVOTS`` different ones, other than the least point of the first turn.
    """
    first = F.min(F.struct(F.xxhash64("low", F.pmod("key", F.lit(PIVOTS))), "low", "component")).over(W.partitionBy("key"))
    met = cells.withColumn("pivot", first).where("component <> pivot.component")
    return met.select(F.least("low", "pivot.low").alias("low_a"), F.greatest("low", "pivot.low").alias("low_b")).distinct()


def _across(cells: DataFrame, classes: DataFrame, similarity: float, most: int | None = None) -> DataFrame:
    """(low_a, low_b): pairs that share a cell, lie in different components and pass the bounds of leaves and points.

    With ``most``, rows (key, null) name the cells where pairs were held back.
    """
    first = cells.withColumn("nth", F.row_number().over(W.partitionBy("low").orderBy("key"))).where(F.col("nth") <= MEETS)
    meets = F.concat(F.sort_array(F.collect_list("key")), F.array_repeat(F.lit((1 << 63) - 1), MEETS - F.count("*").cast("int"))).alias("meets")
    points = cells.join(first.groupBy("low").agg(meets), "low").join(classes.select("low", "n", "counts", "fine"), "low")
    packed = points.withColumn("leaf", F.expr(f"(row_number() OVER (PARTITION BY key ORDER BY n, low, component) - 1) div {LEAF}").cast("int"))
    leaves = packed.groupBy("key", "leaf").agg(
        F.collect_list(F.struct("low", "n", "component", "counts", "fine", "meets")).alias("points"),
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("component").alias("from"), F.max("component").alias("to"),
        F.array(*[F.max(F.col("counts")[g]) for g in range(GROUPS)]).alias("box"),
    )
    leaves = stage(leaves, "leaves")
    flat = ("counts", "meets")
    parts = lambda x: [*[F.col(f"points.{c}").alias(f"{c}_{x}") for c in ("low", "n", "component", "fine")], *[F.flatten(f"points.{c}").alias(f"{c}_{x}") for c in flat]]
    inside = leaves.where("from < to").select("key", *parts("a"), *parts("b"), F.lit(True).alias("same"))
    side = lambda x: leaves.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("leaf", "least", "most", "from", "to", "box")])
    met = side("a").join(side("b"), "key").where("leaf_a < leaf_b AND NOT (from_a = to_a AND from_b = to_b AND from_a = from_b)")
    # sizes in leaf b are not below those in leaf a
    met = met.where(_allows(similarity, "most_a", "most_a", "least_b") + " OR most_a >= least_b")
    met = met.where(_allows(similarity, _minima("box_a", "box_b"), "least_a", "least_b")).select("key", "leaf_a", "leaf_b")
    of = lambda x: leaves.select("key", F.col("leaf").alias(f"leaf_{x}"), *parts(x))
    across = met.join(of("a"), ["key", "leaf_a"]).join(of("b"), ["key", "leaf_b"]).withColumn("same", F.lit(False))
    return stage(inside.unionByName(across.select(*inside.columns)).mapInArrow(_leaf_pairs(similarity, most), "low_a long, low_b long").distinct(), "across")


def near_duplicates(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    spark, key = docs.sparkSession, ["n", "low", "mix"]
    docs = docs.select("doc_id", "text")
    points = stage(docs.mapInArrow(_points(width), _POINTS), "shingle-points")
    rows = points.where("n IS NOT NULL")
    distinct = rows.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("doc_id"), F.first("counts").alias("counts"), F.first("fine").alias("fine"))
    classes = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "shingle-classes")
    firsts = docs.select("text").mapInArrow(_first(width, similarity, _common(points, rows.count())), "key long, low long")
    cell = W.partitionBy("key")
    met = firsts.withColumn("before", F.lag("low").over(cell.orderBy("low"))).withColumns({"pivot": F.min("low").over(cell), "last": F.max("low").over(cell)})
    met = met.where("pivot < last AND (before IS NULL OR before < low)")  # a set once, where there is another one
    cells = stage(met.select("key", "low", "pivot"), "shingle-cells")
    stars = cells.where("low <> pivot").select(F.col("pivot").alias("low_a"), F.col("low").alias("low_b")).distinct()
    pairs = stage(_refined(_bounded(stars, classes, similarity), classes, similarity), "pairs")
    sets = _sets_of(_nodes(pairs), classes, docs, width)
    links = _verified(pairs, sets, similarity)

    def follow(more: DataFrame) -> bool:
        """Verify further pairs of classes; whether there were any."""
        nonlocal pairs, sets, links
        more = stage(more.join(pairs, ["a", "b"], "left_anti"), "pairs")
        if more.isEmpty():
            return False
        new = stage(_nodes(more).join(sets.select("node"), "node", "left_anti"), "nodes")
        if not new.isEmpty():
            sets = sets.union(_sets_of(new, classes, docs, width))
        pairs, links = pairs.union(more), links.union(_verified(more, sets, similarity))
        return True

    # the least neighbour stands for the component while stars are compared: this only lets some pairs more through
    both = links.union(links.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other"))
    cells = _mixed(cells, classes, both.select("node", F.least("node", "other").alias("component")))
    follow(_refined(_bounded(_stars(cells), classes, similarity), classes, similarity))
    found = stage(components(links, spark), "components")
    by_low = lambda x: classes.select(F.col("low").alias(f"low_{x}"), F.col("node").alias(x))
    for most in (BEST, None):
        left = _across(_mixed(cells, classes, found), classes, similarity, most)
        met = left.join(by_low("a"), "low_a").join(by_low("b"), "low_b")
        if follow(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()):
            found = stage(components(links, spark), "components")
        held = left.where("low_b IS NULL").select(F.col("low_a").alias("key"))
        if held.isEmpty():
            break
        cells = cells.join(held, "key")
    named = classes.join(found, "node", "left").select(*key, "doc_id", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_class = named.drop("doc_id").join(least, "component").drop("component")
    return rows.select("doc_id", *key).join(by_class, key, "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op2_shingle_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


_SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM words),
firsts AS (SELECT doc_id, len(s) AS n, unnest(list_sort(s)[1 : len(s) - CAST(ceil(0.8 * len(s) - 1e-9) AS INTEGER) + 1]) AS f FROM sets),
pairs AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM firsts a JOIN firsts b ON a.f = b.f AND a.doc_id < b.doc_id
          WHERE least(a.n, b.n) * 100 >= 80 * greatest(a.n, b.n)),
shared AS (SELECT p.a, p.b, len(x.s) + len(y.s) AS n, len(list_intersect(x.s, y.s)) AS o
             FROM pairs p JOIN sets x ON x.doc_id = p.a JOIN sets y ON y.doc_id = p.b),
half AS (SELECT a, b FROM shared WHERE 100 * o >= 80 * (n - o)),
link AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT a AS doc_id, a AS low FROM link UNION SELECT l.b, r.low FROM reach r JOIN link l ON l.a = r.doc_id WHERE r.low < l.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(r.low, s.doc_id) AS component_id
FROM sets s LEFT JOIN (SELECT doc_id, min(low) AS low FROM reach GROUP BY doc_id) r USING (doc_id)"""

QUERIES = {"op2_shingle_duplicates": op2_shingle_duplicates}
SQL = {"op2_shingle_duplicates": _SQL}
