"""Exact top-k search by integer inner product, longest vectors first.

Vectors are laid out in blocks of descending length (a range partitioning by norm, written to the shared scratch
folder). The block of the longest ones gives every query a first threshold: the score of its k-th best so far. By
Cauchy and Schwarz a query can gain from a block only if the block's greatest length times its own reaches the
threshold; other (query block, vector block) cells are never built. Inside a cell the vectors come in order of length
again, and their inner products are summed over the leading coordinates of an SVD rotation: the partial sum plus the
product of the residual lengths bounds the score, and only pairs whose bound reaches the current threshold are scored,
in integers.

Scale: a cell holds at most some ten thousand vectors and a few thousand queries, so memory is bounded whatever the
table's size; queries meet all vectors in blocks, and the best k of every cell are merged by a rank limit per query.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part; a vector meets those
of its own number of components; rows without id take no part; repeated ids are ordinary rows, a query leaves out every
row with its own id; queries of one id with different vectors are answered each, equal ones once; ties go to the
smaller id, then to one of the equal rows; an empty table gives an empty result. Other columns are ignored.
Scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.llm.common import stage, table

VECTORS_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 4_096
STRIP = 512  # vectors scored at a time; thresholds rise in between
PAIRS = 1 << 16  # pairs scored at a time
_ANSWER = "query long, vec_id long, score long"


def quantized(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, dim, v, norm): components as floor(scale * x), for the vectors that take part."""
    sound = F.expr("embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    v = F.expr(f"transform(embedding, x -> CAST(floor({scale}D * CAST(x AS DOUBLE)) AS BIGINT))")
    taken = vectors.where(sound & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), v.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return taken.select("vec_id", F.size("v").alias("dim"), "v", norm.alias("norm"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of products of components, one set of rows per task and number of components."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, part in batch.groupby("dim"):
            x = _matrix(part["v"]).astype(float)
            sums[dim] = sums.get(dim, 0) + x.T @ x
    for dim, gram in sums.items():
        yield pd.DataFrame({"dim": dim, "cell": np.arange(gram.size), "value": gram.ravel()})


def rotations(items: DataFrame) -> dict[int, np.ndarray]:
    """For each number of components the rotation to the principal axes of all vectors, largest first."""
    sums = items.select("dim", "v").mapInPandas(_grams, "dim int, cell int, value double").groupBy("dim", "cell").agg(F.sum("value").alias("value"))
    out = {}
    for dim, part in sums.toPandas().groupby("dim"):  # dim * dim numbers each
        gram = np.zeros(int(dim) ** 2)
        gram[part["cell"].to_numpy()] = part["value"].to_numpy()
        out[int(dim)] = np.linalg.svd(gram.reshape(dim, dim))[0]
    return out


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best rows, ties to the smaller id."""
    order = np.lexsort((ids, -scores, q))
    grouped = q[order]
    first = np.r_[0, np.flatnonzero(np.diff(grouped)) + 1]
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[rank < k]


def _cell(queries: pd.DataFrame, vectors: pd.DataFrame, rotation: np.ndarray, k: int) -> pd.DataFrame:
    """The k best vectors of the cell for each query, but for pairs that can't reach the query's threshold."""
    vectors = vectors.sort_values(["norm", "vec_id"], ascending=[False, True])
    qv, qid = _matrix(queries["v"]), queries["vec_id"].to_numpy(np.int64)
    cv, cid = _matrix(vectors["v"]), vectors["vec_id"].to_numpy(np.int64)
    least = queries["least"].to_numpy(float)  # -inf while fewer than k are known
    qr, cr = qv @ rotation, cv @ rotation
    dim = rotation.shape[0]
    steps = sorted({max(1, dim // 4), max(1, dim // 2)} - {dim})
    rest = lambda x, h: np.sqrt(np.maximum((x[:, h:] ** 2).sum(axis=1), 0.0))
    q_rest, c_rest = {h: rest(qr, h) for h in steps}, {h: rest(cr, h) for h in steps}
    q_norm, c_norm = rest(qr, 0), rest(cr, 0)
    slack = 1e-6 * (1.0 + q_norm.max(initial=0.0) * c_norm.max(initial=0.0))
    best_q, best_id, best_score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for lo in range(0, len(cv), STRIP):
        strip = slice(lo, lo + STRIP)
        live = np.flatnonzero(q_norm * c_norm[strip].max() + slack >= least)
        if not len(live):
            break  # all later vectors are shorter still
        qi, ci = None, None
        for h in steps:
            if qi is None:
                bound = qr[live, :h] @ cr[strip, :h].T + np.outer(q_rest[h][live], c_rest[h][strip])
                qi, ci = np.nonzero(bound + slack >= least[live][:, None])
                qi, ci = live[qi], ci + lo
            else:
                keep = np.zeros(len(qi), bool)
                for a in range(0, len(qi), PAIRS):
                    p, c = qi[a : a + PAIRS], ci[a : a + PAIRS]
                    part = np.einsum("ij,ij->i", qr[p, :h], cr[c, :h]) + q_rest[h][p] * c_rest[h][c]
                    keep[a : a + PAIRS] = part + slack >= least[p]
                qi, ci = qi[keep], ci[keep]
        if qi is None:
            n = len(cv[strip])
            qi, ci = np.repeat(live, n), np.tile(np.arange(lo, lo + n), len(live))
        other = qid[qi] != cid[ci]
        qi, ci = qi[other], ci[other]
        scores = np.concatenate([np.einsum("ij,ij->i", qv[qi[a : a + PAIRS]], cv[ci[a : a + PAIRS]]) for a in range(0, len(qi), PAIRS)] or [np.zeros(0, np.int64)])
        hit = scores >= least[qi]
        best_q, best_id, best_score = np.r_[best_q, qi[hit]], np.r_[best_id, cid[ci[hit]]], np.r_[best_score, scores[hit]]
        if len(best_q):
            kept = _best(best_q, best_id, best_score, k)
            best_q, best_id, best_score = best_q[kept], best_id[kept], best_score[kept]
            count = np.bincount(best_q, minlength=len(qv))
            lowest = np.full(len(qv), np.iinfo(np.int64).max)
            np.minimum.at(lowest, best_q, best_score)
            full = count >= k
            least[full] = np.maximum(least[full], lowest[full])
    return pd.DataFrame({"query": queries["query"].to_numpy(np.int64)[best_q], "vec_id": best_id, "score": best_score})


def _cells(queries: DataFrame, vectors: DataFrame, turns: dict[int, np.ndarray], k: int) -> DataFrame:
    """``queries`` and ``vectors`` carry (dim, qb, cb); each cell is one group."""

    def cell(key: tuple, q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if q.empty or v.empty:
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query", "vec_id", "score")})
        return _cell(q, v, turns[int(key[0])], k)

    keys = ["dim", "qb", "cb"]
    return queries.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInPandas(cell, _ANSWER)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_top_k(queries: DataFrame, vectors: DataFrame, k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best rows of ``vectors``, all if there are fewer.

    Both tables have vec_id and embedding.
    """
    spark = vectors.sparkSession
    items = quantized(vectors, scale)
    size = items.count()
    laid = items.repartitionByRange(max(1, -(-size // VECTORS_PER_BLOCK)), F.desc("norm"), "vec_id").withColumn("cb", F.spark_partition_id())
    laid = stage(laid, "topk-vectors")
    turns = rotations(laid)
    asked = quantized(queries, scale).dropDuplicates(["vec_id", "v"]).withColumn("query", F.monotonically_increasing_id())
    asked = stage(asked, "topk-queries")
    n_blocks = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    blocks = laid.groupBy("dim", "cb").agg(F.max("norm").alias("top"))
    first = blocks.groupBy("dim").agg(F.max_by("cb", F.struct("top", -F.col("cb"))).alias("cb"))
    seeds = laid.join(first, ["dim", "cb"])
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    start = asked.withColumn("qb", spread).withColumn("least", F.lit(float("-inf"))).join(first, "dim")
    known = _cells(start, seeds.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))), turns, k)
    least = _ranked(known, k).where(F.col("rank") == k).select("query", F.col("score").cast("double").alias("least"))
    bounded = asked.join(least, "query", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    # queries that need vectors of alike length share a block
    need = F.when(F.col("norm") > 0, F.col("least") / F.col("norm")).otherwise(F.lit(float("-inf")))
    bounded = stage(bounded.withColumn("need", need).repartitionByRange(n_blocks, "need", "vec_id").withColumn("qb", F.spark_partition_id()), "topk-bounds")
    needs = bounded.groupBy("dim", "qb").agg(F.min("need").alias("need"))
    cells = needs.join(blocks, "dim").where(F.col("top") * (1 + 1e-9) >= F.col("need")).select("dim", "qb", "cb")
    cells = stage(cells, "topk-cells")
    found = _cells(bounded.join(cells, ["dim", "qb"]), laid.join(cells, ["dim", "cb"]), turns, k)
    named = asked.select("query", F.col("vec_id").alias("query_id"))
    return _ranked(found, k).join(named, "query").select("query_id", "rank", "vec_id", "score")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_top_k(vectors.where("vec_id % 100 = 0"), vectors)


_SQL = """
WITH sound AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
           FROM sound q JOIN sound c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 10"""

QUERIES = {"op6_exact_top_k": op6_exact_top_k}
SQL = {"op6_exact_top_k": _SQL}
