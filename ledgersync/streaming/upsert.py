"""Change rows as a stream, merged by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgersync.operators.sync import append_changes, write_keyed
from ledgersync.registry import ObjectSpec


def change_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet change files as a stream, read with a declared schema."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_upsert(
    stream: DataFrame,
    spec: ObjectSpec,
    ts: str,
    target: str,
    checkpoint: str,
    tie_breakers: Sequence[str] = (),
    on_null_key: str = "drop",
) -> StreamingQuery:
    """Start the upsert stream into a ``write_keyed`` folder and return the query.

    Each micro-batch is reduced to the newest row per key by (``ts``, tie-breakers) and appended to the target's change
    folder; nothing stored is rewritten, so a batch costs what it brings. No row is too late: ``keyed_state`` orders
    stored rows and changes by (``ts``, tie-breakers), so late new keys land, late old versions lose, and replays or a
    batch that is run again change nothing. ``compact`` merges the changes into the target on a slower schedule. Rows
    without a key are dropped, or kept every one with ``on_null_key='insert'``.
    """

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        append_changes(batch, target, spec, f"{checkpoint.rstrip('/')}#{batch_id}", latest_by=[ts, *tie_breakers], on_null_key=on_null_key)

    return stream.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def empty_target(spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64) -> None:
    """Create an empty merge target, so that the first batch has something to merge into."""
    write_keyed(spark.createDataFrame([], schema), path, key, buckets)
