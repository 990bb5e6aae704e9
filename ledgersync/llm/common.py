"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersync.session import scratch_path

#: A word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back.

    Later jobs start from the files, so a lost executor costs one task and not the whole lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_kept: dict[str, Any] = {}


def kept_in_worker(name: str, make: Callable[[], Any]) -> Any:
    """The Python worker's table ``name``: it outlives a task, until the worker makes another one or turns to other work."""
    if name not in _kept:
        forget_kept()
        _kept[name] = make()
    return _kept[name]


def forget_kept() -> None:
    """Give back what the worker kept for a stage before, so that tables of several stages never add up."""
    if _kept:
        _kept.clear()
        pa.default_memory_pool().release_unused()


def components(links: DataFrame, spark: SparkSession) -> DataFrame:
    """(node, component): the smallest node reachable by the undirected ``links`` (a, b).

    Alternates large-star and small-star steps, each one grouping by node with partial minima, until the edges stop
    changing. Every step is written to the shared scratch folder. Nodes without links don't appear. The edges of a
    round never outnumber those of the round before, and a hot node is reduced map-side.
    """
    edges = stage(links.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("x"), F.col("m").alias("y")).where("x <> y").distinct()
        # small star: each node hands its smaller neighbours, and itself, to the smallest of them
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = (
            large.join(least, "x")
            .select(F.explode(F.array("x", "y")).alias("v"), F.col("m").alias("u"))
            .where("v <> u")
            .distinct()
        )
        edges = stage(small.select("u", "v"), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (now.n, now.h) == seen:
            break
        seen = (now.n, now.h)
    stars = edges.groupBy("v").agg(F.min("u").alias("component"))
    return stars.select(F.col("v").alias("node"), "component").union(
        stars.select(F.col("component").alias("node"), "component").distinct()
    )
