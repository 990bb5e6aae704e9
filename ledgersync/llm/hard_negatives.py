"""Hard negatives for contrastive training: per anchor and positive the best rows of other labels in a score window.

Anchors meet all rows in tiles: a tile holds one block of anchors and one block of rows, and its integer inner
products come from Strassen's recursion (seven products of half the size instead of eight, sides padded with zeros to
a multiple of the halvings). Sums and products are of 64-bit integers, so every score that fits a long is exact
whatever the order of additions. A first pass over the tiles whose labels overlap keeps, in one bounded heap per
anchor, the best rows of its own label: the positives. A second pass over all tiles keeps one bounded heap per anchor
and positive, of the rows of other labels whose score lies in the positive's window. Heaps of the tiles are merged by
a rank limit, which Spark applies in each task before the shuffle.

Scale: a tile is at most ``ANCHORS_PER_BLOCK`` by ``ROWS_PER_BLOCK`` rows, scored in strips, and heaps hold k entries
a key, so memory doesn't grow with the table or with a label that holds most rows. Each block of rows is sent once for
each block of anchors.

Defined results: rows whose id, label or vector is null take no part, nor those with an empty vector or with null or
non-finite components; rows meet rows with the same number of components. An anchor leaves out itself by row, not by
id: equal ids are different rows, and an anchor that occurs twice is answered twice. Ties go to the smaller id, then
to one of the equal rows. Anchors without positives, positives without negatives and empty tables give no rows. Other
columns are ignored. 100 times a score must fit a long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.llm.common import stage, table

ANCHORS_PER_BLOCK = 4_096
ROWS_PER_BLOCK = 8_192
STRIP = 512  # rows scored at a time; the heaps' floors rise in between
LEAF = 16  # sides up to this are multiplied directly


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` for matrices of int64, exact as long as the results fit (sums wrap, and wrap back)."""
    (m, k), n = a.shape, b.shape[1]
    halvings = 0
    while min(m, k, n) > leaf << halvings:
        halvings += 1
    if not halvings:
        return a @ b
    to = 1 << halvings
    padded = [np.zeros([-(-side // to) * to for side in x.shape], np.int64) for x in (a, b)]
    for x, whole in zip((a, b), padded, strict=True):
        whole[: x.shape[0], : x.shape[1]] = x
    return _halved(*padded, halvings)[:m, :n]


def _halved(a: np.ndarray, b: np.ndarray, halvings: int) -> np.ndarray:
    if not halvings:
        return a @ b
    (m, k), n = (a.shape[0] // 2, a.shape[1] // 2), b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = _halved(a11 + a22, b11 + b22, halvings - 1)
    p2 = _halved(a21 + a22, b11, halvings - 1)
    p3 = _halved(a11, b12 - b22, halvings - 1)
    p4 = _halved(a22, b21 - b11, halvings - 1)
    p5 = _halved(a11 + a12, b22, halvings - 1)
    p6 = _halved(a21 - a11, b11 + b12, halvings - 1)
    p7 = _halved(a12 - a22, b21 + b22, halvings - 1)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """The k highest scores of each slot; rows are offered in ascending order, so of ties the earlier ones stay."""

    def __init__(self, floor: np.ndarray, k: int) -> None:
        self.floor, self.k = floor.copy(), k  # a score enters a slot only above its floor
        self.slot = self.score = self.row = np.zeros(0, np.int64)

    def offer(self, slot: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, row = np.r_[self.slot, slot], np.r_[self.score, score], np.r_[self.row, row]
        order = np.lexsort((row, -score, slot))
        slot, score, row = slot[order], score[order], row[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        last = rank == self.k - 1
        self.floor[slot[last]] = score[last]
        self.slot, self.score, self.row = (x[rank < self.k] for x in (slot, score, row))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _strips(anchors: pd.DataFrame, rows: pd.DataFrame):
    """(first row, scores of all anchors with a strip of rows)."""
    a, r = _matrix(anchors["v"]), _matrix(rows["v"]).T
    for lo in range(0, r.shape[1], STRIP):
        yield lo, strassen(a, np.ascontiguousarray(r[:, lo : lo + STRIP]))


def _answer(heaps: Heaps, anchors: pd.DataFrame, rows: pd.DataFrame, slots: int) -> pd.DataFrame:
    anchor, row = anchors["place"].to_numpy()[heaps.slot // slots], heaps.row
    return pd.DataFrame(
        {"anchor": anchor, "slot": heaps.slot % slots, "vec_id": rows["vec_id"].to_numpy()[row], "place": rows["place"].to_numpy()[row], "score": heaps.score}
    )


_FOUND = "anchor long, slot long, vec_id long, place long, score long"
_NONE = pd.DataFrame({c.split()[0]: np.zeros(0, np.int64) for c in _FOUND.split(", ")})


def _positives(k: int):
    def tile(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if anchors.empty or rows.empty:
            return _NONE
        rows = rows.sort_values(["vec_id", "place"])
        label, place, own, own_place = (x.to_numpy() for x in (rows["label"], rows["place"], anchors["label"], anchors["place"]))
        heaps = Heaps(np.full(len(own), np.iinfo(np.int64).min), k)
        for lo, score in _strips(anchors, rows):
            at = slice(lo, lo + score.shape[1])
            fits = (own[:, None] == label[at]) & (own_place[:, None] != place[at]) & (score > heaps.floor[:, None])
            slot, row = np.nonzero(fits)
            heaps.offer(slot, score[slot, row], row + lo)
        return _answer(heaps, anchors, rows, 1)

    return tile


def _negatives(k: int, slots: int):
    def tile(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if anchors.empty or rows.empty:
            return _NONE
        rows = rows.sort_values(["vec_id", "place"])
        label, own = rows["label"].to_numpy(), anchors["label"].to_numpy()
        # slots of missing positives have an empty window
        least, most = np.full((len(own), slots), np.iinfo(np.int64).max), np.full((len(own), slots), np.iinfo(np.int64).min)
        for i, windows in enumerate(anchors["windows"]):
            for w in windows:
                least[i, w["slot"]], most[i, w["slot"]] = w["least"], w["most"]
        heaps = Heaps((least - 1).ravel(), k)
        for lo, score in _strips(anchors, rows):
            other = own[:, None] != label[lo : lo + score.shape[1]]
            for s in range(slots):
                fits = other & (score <= most[:, s, None]) & (score > heaps.floor[s::slots, None])
                anchor, row = np.nonzero(fits)
                heaps.offer(anchor * slots + s, score[anchor, row], row + lo)
        return _answer(heaps, anchors, rows, slots)

    return tile


def _sound(scale: int) -> tuple[Column, Column]:
    sound = F.expr("embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    return sound, F.expr(f"transform(embedding, x -> CAST(floor({scale}D * CAST(x AS DOUBLE)) AS BIGINT))")


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, lowest: int = 80, highest: int = 100, scale: int = 256
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchors`` holds.

    ``rows`` has vec_id, label and embedding; components count as floor(scale * x). A negative's score lies between
    ``lowest`` and ``highest`` hundredths of the positive's.
    """
    sound, v = _sound(scale)
    known = rows.where(sound & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    items = known.select(
        F.monotonically_increasing_id().alias("place"), F.col("vec_id").cast("long"), F.col("label").cast("long"), F.size("embedding").alias("dim"), v.alias("v"), F.coalesce(anchors, F.lit(False)).alias("asks")
    )
    items = stage(items, "negatives-rows")
    size = items.agg(F.count("*").alias("rows"), F.count_if("asks").alias("anchors")).first()
    order = ["dim", "label", "vec_id", "place"]
    laid = items.repartitionByRange(max(1, -(-size.rows // ROWS_PER_BLOCK)), *order).withColumn("rb", F.spark_partition_id())
    laid = stage(laid.drop("asks"), "negatives-blocks")
    asked = items.where("asks").drop("asks").repartitionByRange(max(1, -(-size.anchors // ANCHORS_PER_BLOCK)), *order)
    asked = stage(asked.withColumn("ab", F.spark_partition_id()), "negatives-anchors")
    # a few numbers for each block of rows
    ask_blocks = asked.groupBy("dim", "ab").agg(F.min("label").alias("l1"), F.max("label").alias("h1"))
    row_blocks = laid.groupBy("dim", "rb").agg(F.min("label").alias("l2"), F.max("label").alias("h2"))
    tiles = stage(ask_blocks.join(row_blocks, "dim"), "negatives-tiles")
    keys = ["dim", "ab", "rb"]

    def over(tiles: DataFrame, anchors: DataFrame, work, k: int) -> DataFrame:
        left, right = anchors.join(tiles.select(*keys), ["dim", "ab"]), laid.join(tiles.select(*keys), ["dim", "rb"])
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(work, _FOUND)
        best = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "place")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    near = over(tiles.where("l1 <= h2 AND l2 <= h1"), asked.select(*keys[:2], "place", "label", "v"), _positives(positives), positives)
    near = stage(near.select("anchor", (F.col("rank") - 1).cast("long").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    least = F.expr(f"-floor(-{lowest} * positive_score / 100.0BD)").cast("long")
    most = F.expr(f"floor({highest} * positive_score / 100.0BD)").cast("long")
    windows = near.select("anchor", "slot", least.alias("least"), most.alias("most")).where("least <= most")
    windows = windows.groupBy("anchor").agg(F.collect_list(F.struct("slot", "least", "most")).alias("windows"))  # one per positive
    waiting = asked.join(windows, F.col("place") == F.col("anchor")).select(*keys[:2], "place", "label", "v", "windows")
    far = over(tiles, waiting, _negatives(negatives, positives), negatives)
    found = far.select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(near, ["anchor", "slot"])
    named = asked.select(F.col("place").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return found.join(named, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END")
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


_SQL = """
WITH sound AS (
  SELECT row_number() OVER () AS place, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.place AS anchor, a.vec_id AS anchor_id, c.place, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM sound a JOIN sound c ON len(a.v) = len(c.v) AND a.place <> c.place WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor, place AS positive, vec_id AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, place) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN pair n ON n.anchor = p.anchor AND NOT n.same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY p.anchor, p.positive ORDER BY score DESC, vec_id, place)
QUALIFY row_number() OVER best <= 5"""

QUERIES = {"op12_hard_negatives": op12_hard_negatives}
SQL = {"op12_hard_negatives": _SQL}
