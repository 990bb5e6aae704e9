"""Near-duplicate vectors by cosine, found by a pigeonhole join over subspaces.

Unit vectors with cosine c lie at squared distance 2 - 2c. The vectors are rotated and split into blocks of
coordinates, and the squared distance allowed is split among the blocks in proportion to their size; a pair within the
whole distance is within its share in at least one block. Each block is joined by range on its own: a grid over its
leading coordinates, as wide as the block's radius, brings together points of the same and of adjacent cells, each
pair once. A pair is taken in the first block that admits it, so the union of blocks holds it once, and its cosine is
then computed in double precision from the components as given.

Scale: exact copies are reduced to one vector with a count first. Cells are cut into tiles of bounded size, tile against
tile, so a hot cell is spread over tasks and no task holds more than two tiles. Links are counted, never written out:
a tile yields per vector its number of links and one edge that keeps the tile's links connected. The number of grid
coordinates follows the number of vectors, as a number of partitions would. Nothing but the vectors themselves is
written; cells are worked out twice, once to count them.

Defined results: null, empty and zero vectors, and those with null or non-finite components, link with nothing but get
a row; a repeated id links its rows like any others (not by the id), each row is counted, and the output has one row
for each; vectors of unlike numbers of components never link; a null id is an ordinary row, kept if its
component has no other id; an empty table gives an empty result. Other columns,
labels included, are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersync.llm.common import components, stage, table

BLOCKS = 4  # subspaces
TILE = 16_384  # vectors on each side of a tile
ROW = 10_000  # comparisons that cost as much as one more row for a vector
STRIP = 32
PAIRS = 1 << 15
SLACK = 1e-5  # the first comparison is in single precision


def _rotated(x: np.ndarray) -> np.ndarray:
    """Unit vectors under a fixed rotation, padded to a power of two: two rounds of random signs and sums (Hadamard).

    Every step works element by element, so a vector's coordinates are the same bits in whatever company it is rotated.
    """
    dim = 1 << (x.shape[1] - 1).bit_length()
    out = np.zeros((len(x), dim))
    out[:, : x.shape[1]] = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    signs = np.random.default_rng(dim).choice([-1.0, 1.0], size=(2, dim))
    for s in signs:
        out *= s
        width = 1
        while width < dim:
            halves = out.reshape(len(x), -1, 2, width)
            out = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], axis=2).reshape(len(x), dim)
            width *= 2
        out /= np.sqrt(dim)
    return out


def _bounds(dim: int) -> list[int]:
    n = min(BLOCKS, dim)
    return [dim * b // n for b in range(n + 1)]


def _shares(dim: int, distance: float) -> list[float]:
    """The squared distance allowed in each block."""
    at = _bounds(dim)
    return [distance * (at[b + 1] - at[b]) / dim + SLACK for b in range(len(at) - 1)]


def _grid(n: int) -> int:
    """Grid coordinates for ``n`` vectors: each one more leaves about 0.63 of the comparisons and triples the rows."""
    return min(range(1, 9), key=lambda g: n * 0.63**g / 2 + ROW * (3**g + 1) / 2)


def _vectors(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f4").reshape(len(column), -1).astype(float)


def _cells(distance: float, grid: int, full: bool):
    """Rotates vectors and yields the grid cells they enter: their own in each block, and the adjacent ones."""

    def enter(batches):
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                turned = _rotated(_vectors(part["v"]))
                at = _bounds(turned.shape[1])
                for b, share in enumerate(_shares(turned.shape[1], distance)):
                    radius = math.sqrt(share) * (1 + 1e-6)
                    g = min(grid, at[b + 1] - at[b])
                    home = np.floor(turned[:, at[b] : at[b] + g] / radius).astype(np.int64)
                    for step in itertools.product((-1, 0, 1), repeat=g):
                        if step < (0,) * g:
                            continue  # the half of the adjacent cells that comes later
                        rows = pd.DataFrame({"cell": [f"{dim}:{b}:{c}" for c in map(bytes.hex, map(np.ndarray.tobytes, (home + step).astype("<i2")))]})
                        yield rows.assign(block=b, home=not any(step), rep=part["rep"].to_numpy(), copies=part["copies"].to_numpy(), v=part["v"].to_numpy()) if full else rows

    return enter


def _tile(cosine: float):
    distance = 2 - 2 * cosine

    def links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        x = _vectors(rows["v"])
        r = _rotated(x)
        rep, copies, home = rows["rep"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64), rows["home"].to_numpy(bool)
        tile, block, dim = rows["tile"].to_numpy(), int(rows["block"].iloc[0]), r.shape[1]
        at = _bounds(dim)
        share = _shares(dim, distance)
        norm = np.sqrt((x * x).sum(axis=1))
        own = r[:, at[block] : at[block + 1]].astype(np.float32)
        square, one = (own**2).sum(axis=1, keepdims=True), np.ones((len(own), 1), np.float32)
        left, right = np.flatnonzero(home & (tile == i)), np.flatnonzero(tile == j)
        # one product gives 2ab - aa - bb, minus the squared distance
        from_left, from_right = np.hstack([2 * own, -square, -one])[left], np.ascontiguousarray(np.hstack([own, one, square])[right].T)
        least = np.float32(-share[block] - SLACK)
        count, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
        for lo in range(0, len(left), STRIP):
            near = np.flatnonzero(from_left[lo : lo + STRIP] @ from_right >= least)
            if not len(near):
                continue
            p, q = left[lo + near // len(right)], right[near % len(right)]
            ordered = ~home[q] | (rep[p] < rep[q])  # of two points at home in the cell, once
            p, q = p[ordered], q[ordered]
            kept = np.zeros(len(p), bool)
            for lo2 in range(0, len(p), PAIRS):
                s, t = p[lo2 : lo2 + PAIRS], q[lo2 : lo2 + PAIRS]
                gap = (r[s] - r[t]) ** 2
                within = [gap[:, at[b] : at[b + 1]].sum(axis=1) <= share[b] for b in range(block + 1)]
                first = within[block]
                for earlier in within[:block]:
                    first = first & ~earlier
                near_by = (x[s] * x[t]).sum(axis=1) / (norm[s] * norm[t]) >= cosine
                kept[lo2 : lo2 + PAIRS] = first & near_by
            p, q = p[kept], q[kept]
            np.add.at(count, p, copies[q])
            np.add.at(count, q, copies[p])
            for s in np.unique(p):
                group = np.unique(label[np.r_[s, q[p == s]]])
                if len(group) > 1:
                    label[np.isin(label, group)] = group[0]
        hit = count > 0
        return pd.DataFrame({"rep": rep[hit], "links": count[hit], "root": rep[label[hit]]})

    return links


def _as_bytes(batches):
    """Vectors as bytes of single-precision numbers, -0.0 as 0.0 (equal, but unlike as keys)."""
    for batch in batches:
        v = [(np.asarray(x.values, "<f4") + np.float32(0)).tobytes() for x in batch.column("embedding")]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(v, pa.binary())], ["vec_id", "v"])


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>").alias("embedding"))
    sound = F.expr("embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(embedding, x -> x <> 0)")
    rows = vectors.select("vec_id", "embedding", F.coalesce(sound, F.lit(False)).alias("sound"))
    keyed = rows.where("sound").select("vec_id", "embedding").mapInArrow(_as_bytes, "vec_id long, v binary")
    classes = keyed.groupBy("v").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    classes = classes.select(F.monotonically_increasing_id().alias("rep"), F.length("v").alias("dim"), "v", "low", "copies")
    classes = stage(classes, "vectors")
    distance, grid, used = 2 - 2 * cosine, _grid(classes.count()), classes.select("rep", "dim", "v", "copies")
    cells = used.mapInPandas(_cells(distance, grid, False), "cell string")
    # only cells of more than one tile
    tiles = cells.groupBy("cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")).where("tiles > 1")
    entered = used.mapInPandas(_cells(distance, grid, True), "cell string, block int, home boolean, rep long, copies long, v binary")
    dealt = entered.join(tiles, "cell", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    as_left = F.when(F.col("home"), F.transform(every, lambda k: F.struct(F.col("tile").alias("i"), k.alias("j"))))
    as_right = F.transform(every, lambda k: F.struct(k.alias("i"), F.col("tile").alias("j")))
    meets = F.array_distinct(F.concat(as_right, F.coalesce(as_left, F.array().cast("array<struct<i:int,j:int>>"))))
    sent = dealt.withColumn("to", F.explode(meets)).select("cell", F.col("to.i").alias("i"), F.col("to.j").alias("j"), "tile", "block", "home", "rep", "copies", "v")
    found = stage(sent.groupBy("cell", "i", "j").applyInPandas(_tile(cosine), "rep long, links long, root long"), "vector-links")
    groups = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")), spark)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = classes.join(counts, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left").withColumn("group", F.coalesce("component", "rep"))
    known = stage(known.select("v", "group", "low", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-classes")
    by_class = known.join(known.groupBy("group").agg(F.min("low").alias("component_id")), "group").select("v", "n_links", "component_id")
    linked = keyed.join(by_class, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
         WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.95),
reach AS (SELECT a AS vec_id, a AS low FROM link UNION SELECT l.b, r.low FROM reach r JOIN link l ON l.a = r.vec_id WHERE r.low < l.b)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(low, e.vec_id) AS component_id, coalesce(low, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON l.a = e.vec_id
LEFT JOIN (SELECT vec_id, min(low) AS low FROM reach GROUP BY vec_id) r ON r.vec_id = e.vec_id"""

QUERIES = {"op10_vector_near_duplicates": op10_vector_near_duplicates}
SQL = {"op10_vector_near_duplicates": _SQL}
