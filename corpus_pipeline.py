"""A pipeline over ``documents``: language, near duplicates, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and works on every row that its predecessor kept; ``run`` writes each result
below the shared scratch folder and reads it back for the next one. All stages but the last return the columns of
documents. Decisions are made for rows, whatever their ids: repeated and null ids are rows like others, and of rows
with equal or nearly equal texts exactly one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersync.llm import byte_language, pieces, shingle_join
from ledgersync.llm.common import stage, table
from ledgersync.llm.mixing import mixed_documents

#: Documents whose best language has a mean probability below this many times chance are rejected, as are those without
#: letters. A few words of a learned language can score little more than chance, and clean documents must stay.
ABOVE_CHANCE = 1.2

#: Most bytes of an Arrow batch in the stages that work in Python. Some texts and shingle sets are hundreds of times longer
#: than others, so a number of rows alone doesn't bound what a task holds.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by ``BATCH_BYTES``; a lower bound that is set already stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognisable language; learned from the labels of ``docs`` outside the held-out fold."""
    bound_batches(spark)
    net = byte_language.fit(docs)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    least = ABOVE_CHANCE / len(net.languages) if net and len(net.languages) > 1 else 0.0
    return byte_language.identify(row, net).where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("row.*")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row: the smallest id, nulls last, and of its rows one by content."""
    bound_batches(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = stage(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("key")), "pipeline-rows")
    groups = shingle_join.near_duplicates(keyed.select(F.col("key").alias("doc_id"), "row.text"))
    order = F.struct(F.col("row.doc_id").isNull(), "row.doc_id", F.xxhash64("row.text", "row.source"), "key")
    ranked = keyed.select("key", order.alias("order")).join(groups.select(F.col("doc_id").alias("key"), "component_id"), "key")
    kept = ranked.groupBy("component_id").agg(F.min("order").alias("first")).select(F.col("first.key").alias("key"))
    return keyed.join(kept, "key", "left_semi").select("row.*")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: documents repeated, cut or left out as the schedule takes them.

    A row counts by its content here, so that a rerun over other files of the same rows mixes alike. Its text lies outside
    ``row``, as the mix shuffles what it is given.
    """
    made = {"text": F.col("text"), "source": F.col("source"), "n_chars": F.char_length("text").cast("long")}
    rest = [c for c in docs.columns if c not in made]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    mixed = mixed_documents(docs.select(row.alias("row"), F.xxhash64("doc_id", "text", "source").alias("doc_id"), "text", "source"))
    return mixed.select(*[made[c].alias(c) if c in made else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mixture, decoded again and compared with its text."""
    bound_batches(spark)
    encoded = pieces.with_ids(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "lang", "source", "n_chars", "n_ids", "ids", "round_trip")


STAGES = [("language", language_stage), ("near_duplicates", dedup_stage), ("mixture", mix_stage), ("token_ids", encode_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
