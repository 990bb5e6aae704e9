"""Polling with a high-watermark that is stored with what was pulled."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from ledgersync.functions.clock import as_datetime
from ledgersync.operators.sync import append_changes, incremental_pull
from ledgersync.registry import ObjectSpec
from ledgersync.sources.folders import names_below


def _watermarks(target: str) -> str:
    return f"{target.rstrip('/')}-watermarks"


def watermark(spark: SparkSession, target: str) -> datetime | None:
    """The time up to which the last finished run has pulled; None before the first."""
    found = names_below(spark, _watermarks(target), "until=")
    return max((datetime.strptime(f, "%Y%m%dT%H%M%S%f") for f in found), default=None)


def store_watermark(spark: SparkSession, target: str, until: datetime) -> None:
    spark.createDataFrame([(until.isoformat(),)], "until string").coalesce(1).write.mode("overwrite").parquet(f"{_watermarks(target)}/until={until:%Y%m%dT%H%M%S%f}")


def pull_changes(
    source: DataFrame, target: str, spec: ObjectSpec, changed: str, until: str | datetime, overlap: timedelta, tie_breakers: Sequence[str] = ()
) -> bool:
    """Append the rows changed since the stored watermark, less an overlap and up to ``until``, to a ``write_keyed`` folder.

    The batch is named by ``until`` and written first, the watermark after it. A run that stops in between leaves the
    watermark where it was, so the next one pulls the same rows again: under the same ``until`` they replace the batch, under
    a later one they come twice and the newest row of a key counts once. False if ``until`` was reached before.
    """
    spark, end = source.sparkSession, as_datetime(until)
    since = watermark(spark, target)
    if since is not None and end <= since:
        return False
    pulled = incremental_pull(source, changed, since, overlap, end)
    append_changes(pulled, target, spec, f"until {end.isoformat()}", latest_by=[changed, *tie_breakers])
    store_watermark(spark, target, end)
    return True
