"""The stream reaches the same state as one batch merge."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from ledgersync.operators.sync import compact, keyed_state, merge_object
from ledgersync.registry import ObjectSpec
from ledgersync.streaming.upsert import change_stream, empty_target, stream_upsert

SPEC = ObjectSpec("state", "k", {"k": "K", "v": "V", "ts": "T"})
DDL = "k long, v long, ts timestamp_ntz"


def run(spark, source, target, checkpoint):
    stream = change_stream(spark, source, DDL, files_per_trigger=1)
    query = stream_upsert(stream, SPEC, "ts", target, checkpoint, tie_breakers=["v"])
    query.awaitTermination()


def state(spark, target):
    return sorted(tuple(r) for r in keyed_state(spark, target, SPEC, DDL, ["ts", "v"]).select("k", "v", "ts").collect())


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(3)
    base = datetime(2024, 1, 1)
    changes = []
    for step in range(4):
        rows = [(rng.randrange(30), 1000 * step + i, base + timedelta(hours=12 * step, minutes=rng.randrange(600))) for i in range(40)]
        rows += rng.sample(changes, min(5, len(changes)))  # exact replays
        changes += rows
        spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{step}"))
    target = str(tmp_path / "target")
    empty_target(spark, target, DDL, "k", 4)
    run(spark, str(tmp_path / "in" / "*"), target, str(tmp_path / "cp"))
    batch = merge_object(
        spark.createDataFrame([], DDL), spark.createDataFrame(changes, DDL), SPEC, on_duplicate="latest", latest_by=["ts", "v"]
    )
    assert state(spark, target) == sorted(tuple(r) for r in batch.collect())
    run(spark, str(tmp_path / "in" / "*"), target, str(tmp_path / "cp2"))  # the same files again change nothing
    assert state(spark, target) == sorted(tuple(r) for r in batch.collect())


def test_late_rows_land_and_late_versions_lose(spark, tmp_path):
    base = datetime(2024, 1, 10)
    target = str(tmp_path / "target")
    empty_target(spark, target, DDL, "k", 4)
    files = [(1, 1, base + timedelta(days=5)), (2, 2, base), (1, 9, base), (1, 7, base + timedelta(days=5)), (1, 3, base + timedelta(days=5)), (None, 1, base)]
    for step, row in enumerate(files):
        spark.createDataFrame([row], DDL).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{step}"))
        run(spark, str(tmp_path / "in" / "*"), target, str(tmp_path / "cp"))
    want = [(1, 7, base + timedelta(days=5)), (2, 2, base)]  # the late new key is there, ties go to the greater v
    assert state(spark, target) == want
    for _ in range(2):  # merging again changes nothing
        compact(spark, target, SPEC, ["ts", "v"])
        assert sorted(tuple(r) for r in spark.read.schema(DDL).parquet(target).select("k", "v", "ts").collect()) == want
        assert state(spark, target) == want
