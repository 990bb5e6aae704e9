"""Session helpers: tuned builder and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Safe at any scale: partition counts and skew splits are decided at run time
# from measured shuffle sizes, and broadcasts stay behind Spark's size check.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "ledgersync", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the folder on a cluster. A local session
    (tests) that has none gets a temporary one; a cluster session without it is
    an error, because executors would not share a driver-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="ledgersync-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """What is written inside gives back its shuffle files at its end, not when the driver next collects garbage.

    For writes only: an action that is run again on the same DataFrame would have to shuffle anew.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back, so that what follows starts from files."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_given_back(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
