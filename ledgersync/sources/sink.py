"""Upsert batches for the downstream loader."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgersync.operators.sync import one_row_per_key
from ledgersync.registry import OBJECTS, PUBLISHED
from ledgersync.session import shuffles_given_back
from ledgersync.sources.folders import move_folder, remove_folder


def write_upsert_batch(df: DataFrame, object_name: str, key: str, path: str, batch_id: str) -> str:
    """Write one object's batch; a missing or repeated key fails the job before anything is committed.

    The folder is ``path/object=<name>/batch=<id>``; writing a batch again replaces it. The rows are written once, beside
    the folder under a name that readers pass over; only their keys are read again, and the checked files move into place.
    """
    spec = OBJECTS[object_name]
    if key != spec.key:
        raise ValueError(f"{object_name} is keyed by {spec.key}, not {key}")
    spark, folder = df.sparkSession, f"{path.rstrip('/')}/object={object_name}"
    out, staged, rows = f"{folder}/batch={batch_id}", f"{folder}/_staged-{uuid.uuid4().hex}", spec.to_crm(df.select(*spec.columns))
    try:
        with shuffles_given_back(spark):
            rows.write.parquet(staged)
            keys = spark.read.schema(rows.schema).parquet(staged).select(F.col(spec.fields[key]).alias(key))
            one_row_per_key(keys, key, on_duplicate="error", on_null_key="error", staged=True).write.format("noop").mode("overwrite").save()
        move_folder(spark, staged, out)
    except BaseException:
        remove_folder(spark, staged)
        raise
    return out


def publish_all(staged: dict[str, DataFrame], path: str, batch_id: str) -> dict[str, str]:
    """Write the batch of every published object that is staged, in push order."""
    return {n: write_upsert_batch(staged[n], n, k, path, batch_id) for n, k in PUBLISHED if n in staged}


NO_KEY, REPEATED_KEY = "no key", "repeated key"


@dataclass(frozen=True)
class Batch:
    """A written batch: its accepted and rejected rows, as folder and count."""

    accepted: str
    rejected: str
    n_accepted: int
    n_rejected: int


def write_quarantined(df: DataFrame, object_name: str, key: str, path: str, batch_id: str) -> Batch:
    """Write one object's batch without failing on bad keys: rows without a key and all rows of a repeated key are set
    aside with a reason, the others are written as the loader expects them.

    Both parts come from one write of one pass, and are counted by it. Writing a batch again replaces it.
    """
    spec = OBJECTS[object_name]
    if key != spec.key:
        raise ValueError(f"{object_name} is keyed by {spec.key}, not {key}")
    rows = df.select(*spec.columns)
    repeated = rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    joined = rows.filter(F.col(key).isNotNull()).join(repeated, F.col(key) == F.col("__k"), "left")
    known = joined.withColumn("reason", F.when(F.col("__n").isNotNull(), REPEATED_KEY)).drop("__k", "__n")
    tagged = known.unionByName(rows.filter(F.col(key).isNull()).withColumn("reason", F.lit(NO_KEY)))  # keyless rows aren't shuffled
    out = spec.to_crm(tagged.select(*spec.columns)).columns
    named = tagged.select(F.lit(None).cast("string").alias("ID"), *[F.col(c).alias(n) for c, n in spec.fields.items()], "reason")
    seen = Observation()
    counted = named.observe(seen, F.count_if(F.col("reason").isNull()).alias("accepted"), F.count("reason").alias("rejected"))
    to = f"{path.rstrip('/')}/object={object_name}/batch={batch_id}"
    verdict = F.when(F.col("reason").isNull(), "accepted").otherwise("rejected")
    counted.select(*out, "reason", verdict.alias("verdict")).write.mode("overwrite").partitionBy("verdict").parquet(to)
    counts = seen.get
    return Batch(f"{to}/verdict=accepted", f"{to}/verdict=rejected", counts["accepted"], counts["rejected"])
