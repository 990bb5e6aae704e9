"""Mixing sources to target weights by a low-discrepancy schedule.

Slot ``i`` of the schedule stands at the golden-ratio point ``frac((i + 1) * phi)``; the source whose interval of the
cumulative target weights holds the point gets the slot. Slots are ranked per source, and rank ``r`` takes block
``r mod blocks`` of the source's shuffled stream of words, cut into blocks of equally many words. Only DataFrame
functions are used.

Scale: texts are read once and reduced to (id, source, size). Ranks and stream positions are sums of two levels, so
that a source with a third of all rows is spread over many tasks: slots by chunk of the schedule, documents by a prefix
of their shuffle key. Tables with one row per source are treated as small.

Defined results: a null or blank text has size 0 and is never taken; a null source is a source of its own, the last in
order; a null id is an ordinary value; repeated rows are mixed one by one; an empty table gives an empty result.
Columns other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.llm.common import WORD, stage, table

#: The golden ratio as a 32-bit fraction; (i + 1) * PHI modulo 2**32 are the schedule's points.
PHI = 2654435769
CELLS = 4096  # cells by which points meet the interval of their source
CHUNK = 1 << 16  # slots ranked together


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key): words of the text and the shuffle key."""
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(f"({WORD})")), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("key"),
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source: (source, source_size, target), and its interval of the schedule [lo, hi) in 32 bits.

    The water level: sources fill by weight, and those whose limit (``most`` times their size) lies below the level
    keep the limit. With sources in order of limit per weight, the first ones are the limited ones.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    ranked = by_source.withColumn("nth", F.row_number().over(order) - 1).withColumn("w", w.cast("double"))
    every = W.partitionBy()
    fill = W.orderBy(F.col("source_size") / F.col("w"), "nth")
    level = (
        ranked.withColumn("all_words", F.lit(share) * F.sum("source_size").over(every))
        .withColumn("limited", most * F.sum("source_size").over(fill.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("left_w", F.sum("w").over(fill.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("rest", F.col("all_words") - F.coalesce("limited", F.lit(0)))
        .withColumn("fits", F.col("rest") * F.col("w") / F.col("left_w") <= most * F.col("source_size"))
    )
    # the first source that fits sets the level for itself and all after it
    first = F.min(F.when(F.col("fits"), F.struct(F.col("source_size") / F.col("w"), "nth", "rest", "left_w"))).over(every)
    level = level.withColumn("at", first).withColumn(
        "target",
        F.when(
            F.col("at").isNull() | (F.struct(F.col("source_size") / F.col("w"), "nth") < F.struct(F.col("at.col1"), F.col("at.nth"))),
            (most * F.col("source_size")).cast("double"),
        ).otherwise(F.col("at.rest") * F.col("w") / F.col("at.left_w")),
    )
    until = F.sum("target").over(W.orderBy("nth").rowsBetween(W.unboundedPreceding, 0))
    total = F.sum("target").over(every)
    bound = F.when(total > 0, F.floor(until / total * 4294967296.0)).otherwise(F.lit(0)).cast("long")
    out = level.select("source", "nth", "source_size", "target", bound.alias("hi"), total.alias("total"))
    last = F.max("nth").over(every)
    out = out.withColumn("hi", F.when(F.col("nth") == last, F.lit(1 << 32)).otherwise(F.col("hi")))
    return out.withColumn("lo", F.coalesce(F.lag("hi").over(W.orderBy("nth")), F.lit(0)))


def schedule(goals: DataFrame, block_words: int) -> DataFrame:
    """(slot, nth, rank): the source of each slot and its place among the source's slots."""
    spark = goals.sparkSession
    total = goals.agg(F.first("total")).first()[0] or 0.0
    n = int(total / block_words + 0.5)
    width = (1 << 32) // CELLS
    slots = spark.range(n).select(
        F.col("id").alias("slot"), (((F.col("id") + 1) % (1 << 31)) * F.lit(PHI) % (1 << 32)).alias("point")
    )
    cells = goals.where("hi > lo").select("nth", "lo", "hi", F.explode(F.expr(f"sequence(lo div {width}, (hi - 1) div {width})")).alias("cell"))
    dealt = (
        slots.withColumn("cell", F.expr(f"point div {width}"))
        .join(cells, "cell")
        .where("point >= lo AND point < hi")
        .select("slot", "nth", F.expr(f"slot div {CHUNK}").alias("chunk"))
    )
    before = dealt.groupBy("nth", "chunk").agg(F.count("*").alias("n"))
    before = before.select(
        "nth", "chunk", F.coalesce(F.sum("n").over(W.partitionBy("nth").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base")
    )
    local = F.row_number().over(W.partitionBy("nth", "chunk").orderBy("slot")) - 1
    return dealt.withColumn("local", local).join(before, ["nth", "chunk"]).select("slot", "nth", (F.col("base") + F.col("local")).alias("rank"))


def positions(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Documents with their place [start, start + size) in their source's shuffled stream of words."""
    docs = sized.join(goals.select("source", "nth", "source_size", "target"), sized["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    docs = docs.withColumn("part", F.substring("key", 1, 3))
    before = docs.groupBy("nth", "part").agg(F.sum("size").alias("n"))
    before = before.select(
        "nth", "part", F.coalesce(F.sum("n").over(W.partitionBy("nth").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base")
    )
    inner = W.partitionBy("nth", "part").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    docs = docs.withColumn("local", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return docs.join(before, ["nth", "part"]).withColumn("start", F.col("base") + F.col("local")).drop("base", "local", "part")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, block_words: int = 32
) -> DataFrame:
    """Per document (doc_id, source, size, source_size, target, taken, first, second).

    ``taken`` counts the words that the mix takes, repeats included; ``first`` and ``second`` are the words taken in
    the first and second pass over the source, always the leading ones. The words taken of a source end within a few
    blocks of its target, and no document is taken more than ``most`` times.
    """
    sized = stage(sizes(docs), "mix-sizes")
    goals = stage(targets(sized, weights, share, most), "mix-targets")
    blocks = goals.select("nth", F.expr(f"(source_size + {block_words - 1}) div {block_words}").alias("blocks")).where("blocks > 0")
    taken = (
        schedule(goals, block_words)
        .join(blocks, "nth")
        .where(F.col("rank") < most * F.col("blocks"))
        .groupBy("nth", F.expr("rank % blocks").alias("block"))
        .agg(F.count("*").alias("times"))
    )
    placed = positions(sized, goals).withColumn("row", F.struct("doc_id", "key", "size", "start"))
    pieces = placed.where("size > 0").select(
        "nth", "start", "size", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")).alias("block")
    )
    words = F.expr(f"least(start + size, (block + 1) * {block_words}) - greatest(start, block * {block_words})")
    # start is unique among the documents of a source that have words
    sums = (
        pieces.join(taken, ["nth", "block"])
        .groupBy("nth", "start")
        .agg(
            F.sum(words * F.col("times")).alias("taken"),
            F.sum(F.when(F.col("times") >= 1, words).otherwise(0)).alias("first"),
            F.sum(F.when(F.col("times") >= 2, words).otherwise(0)).alias("second"),
        )
    )
    none = F.lit(0).cast("long")
    hit = (F.col("size") > 0) & F.col("taken").isNotNull()
    return placed.join(sums, ["nth", "start"], "left").select(
        "doc_id", "source", "size", "source_size", "target", *[F.when(hit, F.col(c)).otherwise(none).alias(c) for c in ("taken", "first", "second")]
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each pass that takes words of it, cut to the words taken.

    Rows that share an id also share its decision. Texts taken whole stay as they are.
    """
    made = mix_sources(docs, **options).select(F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("size").alias("_size"), "first", "second").dropDuplicates(["_id", "_src", "_size"])
    passes = made.select("_id", "_src", "_size", F.posexplode(F.array("first", "second")).alias("_pass", "_words")).where("_words > 0")
    size = F.coalesce(F.regexp_count("text", F.lit(f"({WORD})")), F.lit(0)).cast("long")
    joined = docs.withColumn("_n", size).join(passes, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_src")) & (F.col("_n") == F.col("_size")))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), F.lit(1), F.col("_words").cast("int")), " ")
    text = F.when(F.col("_words") >= F.col("_n"), F.col("text")).otherwise(cut)
    fields = [text.alias(c) if c == "text" else F.char_length(text).cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return joined.select(*fields)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _oracle() -> str:
    b = 32
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
s AS (SELECT *, CAST([3, 1, 2][nth % 3 + 1] AS DOUBLE) AS w FROM s0),
f AS (SELECT *, 1.5::DOUBLE * (SELECT sum(source_size) FROM s) - coalesce(2 * sum(source_size) OVER before, 0) AS rest,
             sum(w) OVER rest_of AS left_w, row_number() OVER (ORDER BY source_size / w, nth) AS k
      FROM s WINDOW before AS (ORDER BY source_size / w, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    rest_of AS (ORDER BY source_size / w, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
cut AS (SELECT * FROM f WHERE rest * w / left_w <= 2 * source_size ORDER BY k LIMIT 1),
t0 AS (SELECT f.source, f.nth, f.source_size,
              CASE WHEN cut.k IS NULL OR f.k < cut.k THEN CAST(2 * f.source_size AS DOUBLE) ELSE cut.rest * f.w / cut.left_w END AS target
       FROM f LEFT JOIN cut ON true),
t1 AS (SELECT *, sum(target) OVER (ORDER BY nth) AS until, sum(target) OVER () AS total, max(nth) OVER () AS top FROM t0),
t2 AS (SELECT *, CASE WHEN nth = top THEN 4294967296 ELSE CAST(floor(until / total * 4294967296.0::DOUBLE) AS BIGINT) END AS hi FROM t1),
t AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY nth), 0) AS lo, (source_size + {b - 1}) // {b} AS blocks FROM t2),
slots AS (SELECT i AS slot, ((i + 1) % 2147483648) * 2654435769 % 4294967296 AS point
          FROM range(CAST((SELECT floor(any_value(total) / {b} + 0.5) FROM t) AS BIGINT)) AS r(i)),
ranked AS (SELECT t.nth, t.blocks, row_number() OVER (PARTITION BY t.nth ORDER BY slot) - 1 AS rank
           FROM slots JOIN t ON point >= lo AND point < hi),
taken AS (SELECT nth, rank % blocks AS block, count(*) AS times FROM ranked WHERE rank < 2 * blocks GROUP BY ALL),
placed AS (SELECT d.*, t.nth, t.source_size, t.target,
                  coalesce(sum(size) OVER (PARTITION BY t.nth ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
           FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
pieces AS (SELECT nth, start, size, unnest(range(CAST(start // {b} AS BIGINT), CAST((start + size - 1) // {b} + 1 AS BIGINT))) AS block FROM placed WHERE size > 0),
sums AS (SELECT p.nth, p.start, sum((least(start + size, (p.block + 1) * {b}) - greatest(start, p.block * {b})) * times) AS taken
         FROM pieces p JOIN taken USING (nth, block) GROUP BY ALL)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN size > 0 THEN coalesce(taken, 0) ELSE 0 END AS BIGINT) AS taken
FROM placed LEFT JOIN sums USING (nth, start)"""


QUERIES = {"op8_source_mix": op8_source_mix}
SQL = {"op8_source_mix": _oracle()}
