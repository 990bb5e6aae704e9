"""Exact membership of integer keys by bitmaps, for key lists too long to broadcast as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersync.operators.joins import member_split
from ledgersync.session import stored

BITMAP_BYTES = 4_096  # of one bucket, 32,768 keys
BROADCAST_LIMIT = 64 << 20  # bytes of all bitmaps up to which they are sent to every task


def key_bitmaps(keys: DataFrame, key: str) -> DataFrame:
    """(bucket, bits): one bitmap for each bucket of 32,768 neighbouring integers that holds a listed one.

    Bitmaps are built map-side first, so the list is shuffled as one row for each task and bucket.
    """
    k = keys.select(F.col(key).cast("long").alias("__k")).dropna()
    return k.groupBy(F.bitmap_bucket_number("__k").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("__k")).alias("bits"))


def bit_set(bits: str, key: str) -> Column:
    """Whether the bitmap column holds the bit of ``key``; false without a bitmap."""
    at = f"bitmap_bit_position(CAST(`{key}` AS BIGINT))"
    byte = f"CAST(conv(hex(substring({bits}, CAST({at} DIV 8 AS INT) + 1, 1)), 16, 10) AS BIGINT)"
    return F.expr(f"COALESCE(getbit({byte}, CAST({at} % 8 AS INT)) = 1, FALSE)")


def mark_members(df: DataFrame, key: str, bitmaps: DataFrame, name: str) -> DataFrame:
    """Add the flag ``name``: whether ``key`` is in the bitmaps. ``df`` is not shuffled: the bitmaps are broadcast."""
    few = F.broadcast(bitmaps.select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits")))
    joined = df.join(few, F.bitmap_bucket_number(F.col(key).cast("long")) == F.col("__bucket"), "left")
    return joined.withColumn(name, bit_set("__bits", key)).drop("__bucket", "__bits")


def member_split_bitmap(df: DataFrame, key: str, keys: DataFrame, limit: int = BROADCAST_LIMIT) -> tuple[DataFrame, DataFrame]:
    """``member_split`` for integer keys by bitmaps: a dense list costs one bit a key instead of a row.

    The bitmaps are stored and counted first. A list so scattered that they pass ``limit`` bytes is joined as rows.
    """
    maps = stored(key_bitmaps(keys, keys.columns[0]), "key-bitmaps")
    if maps.count() * BITMAP_BYTES > limit:
        return member_split(df, key, keys)
    marked = mark_members(df.filter(F.col(key).isNotNull()), key, maps, "__member")
    return marked.filter("__member").drop("__member"), marked.filter("NOT __member").drop("__member")
