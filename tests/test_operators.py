"""Joins, numbering and merging on small and skewed rows, against brute force."""

from __future__ import annotations

import random
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgersync.operators import joins as J
from ledgersync.operators import sync as R
from ledgersync.operators.aggregates import Bucket, bucket_sums, oldest_unpaid
from ledgersync.operators.windows import latest_per_key, number_lines
from ledgersync.registry import OBJECTS, PUBLISHED, ObjectSpec
from ledgersync.session import scratch_path
from ledgersync.sources.catalog import TableCatalog
from ledgersync.sources.inline import inline_table, vendor_rows
from ledgersync.sources.sink import write_upsert_batch


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def spans_and_events(seed: int):
    """One key holds most rows; starts, ends and clock times include midnights and open ends."""
    rng = random.Random(seed)
    base = datetime(2000, 1, 1)

    def moment(days):
        t = base + timedelta(days=rng.randrange(days))
        return t if rng.random() < 0.4 else t + timedelta(seconds=rng.randrange(86400))

    spans = []
    for i in range(150):
        start = moment(900)
        length = rng.choice([0, 0.3, 1, 2, 40, 700, 6000])
        end = None if rng.random() < 0.3 else start + timedelta(days=length * rng.random())
        spans.append((1 if rng.random() < 0.7 else rng.randrange(4), i, start, end))
    events = [(i, 1 if rng.random() < 0.7 else rng.randrange(5), moment(1400)) for i in range(400)]
    events += [(1000 + i, k, s) for i, (k, _, s, _) in enumerate(spans[:60])]
    events += [(2000 + i, k, e) for i, (k, _, _, e) in enumerate(spans[:60]) if e]
    return spans, events


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_interval_operators_equal_brute_force(spark, seed):
    spans, events = spans_and_events(seed)
    as_of = datetime(2002, 6, 1, 9)
    s = spark.createDataFrame(spans, "k long, c long, start_date timestamp_ntz, end_date timestamp_ntz")
    e = spark.createDataFrame(events, "id long, k long, at timestamp_ntz")
    hits = [(i, k, at, c) for i, k, at in events for sk, c, lo, hi in spans if sk == k and lo <= at <= (hi or as_of)]
    joined = J.interval_join(e, s, "k", "at", "start_date", "end_date", as_of)
    assert rows(joined.select("id", "k", "at", "c")) == sorted(hits, key=repr)
    least = {}
    for i, k, at, c in hits:
        least[i] = (i, k, at, min(c, least[i][3]) if i in least else c)
    got = J.interval_min(e, s, "k", "at", "start_date", "end_date", ["c"], "id", as_of)
    assert rows(got.select("id", "k", "at", "c")) == sorted(least.values(), key=repr)


def test_member_split_partitions_known_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k long")
    inside, outside = J.member_split(df, "k", spark.createDataFrame([(2,), (None,)], "x long"))
    assert rows(inside) == [(2,)] and rows(outside) == [(1,), (3,)]


def test_extreme_rows_keep_ties_and_skip_null(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d")], "k int, v int, t string")
    assert rows(J.extreme_rows(df, ["k"], "v").select("t")) == [("a",), ("b",)]
    assert rows(J.extreme_rows(df, ["k"], "v", "min").select("t")) == [("c",)]


def test_latest_needs_an_order(spark):
    with pytest.raises(ValueError):
        latest_per_key(spark.range(1).toDF("k"), ["k"], [])


@pytest.mark.parametrize("spread", [0, 1, 2])
def test_line_numbers_are_dense(spark, spread):
    rng = random.Random(7)
    data = [(1 if rng.random() < 0.6 else rng.randrange(3), rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2]), i) for i in range(300)]
    df = spark.createDataFrame(data, "j int, d int, c int, i int")
    got = {(r.i): r.line_no for r in number_lines(df, "j", ["d", "c", "i"], spread=spread).collect()}
    want = {}
    for j in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == j), key=lambda r: tuple((x is not None, x or 0) for x in r[1:]))
        want |= {r[3]: n for n, r in enumerate(mine, 1)}
    assert got == want


def test_bucket_without_rows_is_null_or_default(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    out = bucket_sums(df, ["k"], "v", [Bucket("a", "v > 5"), Bucket("b", "v > 5", default=0), Bucket("c", "v > 0", -1)])
    assert rows(out) == [(1, None, 0, -2)]


def test_oldest_unpaid_compares_each_due_date_with_the_whole_header(spark):
    day = [datetime(2024, 1, d) for d in range(1, 8)]
    details = spark.createDataFrame(
        [(1, 10, 7, 1, 11020, 100, day[0]), (2, 10, 7, 1, 11020, 50, day[1]), (3, 11, 7, 1, 11022, 10, day[0]), (4, 12, 8, 99, 11020, 9, day[0])],
        "invoice_detail_oid long, invoice_header_oid long, contract_oid long, transaction_code_oid long, open_closed_oid long,"
        " original_due_amount int, due_date timestamp_ntz",
    )
    pay = spark.createDataFrame([(1, 60, day[2]), (2, 40, day[2]), (2, 999, day[6])], "invoice_detail_oid long, applied_amount int, applied_date timestamp_ntz")
    assert rows(oldest_unpaid(details, pay, day[1])) == [(7, day[0])]
    assert rows(oldest_unpaid(details, pay, day[4])) == []


def test_snapshot_diff_null_rules(spark):
    cur = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 5), (5, None)], "k int, v int")
    prev = spark.createDataFrame([(2, None), (3, 5), (4, 6), (5, 1)], "k int, v int")
    status = {r.k: r.change_status == R.CHANGED for r in R.snapshot_diff(cur, prev, "k", ["v"]).collect()}
    assert status == {1: False, 2: False, 3: False, 4: True, 5: False}
    strict = {r.k: r.change_status == R.CHANGED for r in R.snapshot_diff(cur, prev, "k", ["v"], null_safe=True, new_rows=True).collect()}
    assert strict == {1: True, 2: True, 3: False, 4: True, 5: True}


def test_attribute_resolution(spark):
    fields = spark.createDataFrame([(23, "Opportunity")], "oid long, descr string")
    values = spark.createDataFrame([(23, 2, None), (23, 3, "A"), (23, 3, "A"), (24, 1, "B")], "genf_oid long, ref_oid long, field_value string")
    base = spark.createDataFrame([(1,), (2,), (3,)], "contract_oid long")
    assert rows(R.eav_resolve(fields, values, base)) == [(2, "NULL"), (3, "A")]
    assert rows(R.eav_resolve(fields, values, base, default=None, how="left")) == [(1, None), (2, None), (3, "A")]


TARGET = [(1, "old", 1), (2, "old", 2), (None, "old", 3)]
SCHEMA = "k int, a string, b int"


def test_merge_arms(spark):
    t = spark.createDataFrame(TARGET, SCHEMA)
    s = spark.createDataFrame([(2, "new", None), (3, "new", 9), (None, "new", 4), (None, "new", 4)], SCHEMA)
    got = rows(R.merge_upsert(t, s, "k", update_cols=["b"], defaults={"b": 0}))
    assert got == sorted([(1, "old", 1), (2, "old", 0), (3, "new", 9), (None, "old", 3), (None, "new", 4), (None, "new", 4)], key=repr)
    assert (None, "new", 4) not in rows(R.merge_upsert(t, s, "k", on_null_key="drop"))


def test_rows_without_key_are_spread_and_kept(spark):
    t = spark.createDataFrame([(None, "old", i) for i in range(400)] + [(1, "old", 0)], SCHEMA)
    s = spark.createDataFrame([(None, "new", i) for i in range(400)] + [(1, "new", 0)], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = R.merge_upsert(t, s, "k")
        assert out.count() == 801 and out.filter("k = 1 AND a = 'new'").count() == 1
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 400
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_merge_is_idempotent_and_keeps_other_rows(spark):
    t = spark.createDataFrame([(i, "old", i) for i in range(50)], SCHEMA)
    s = spark.createDataFrame([(i, "new", -i) for i in range(40, 60)], SCHEMA)
    once = R.merge_upsert(t, s, "k")
    assert rows(R.merge_upsert(once, s, "k")) == rows(once)
    assert rows(once.filter("k < 40")) == rows(t.filter("k < 40")) and once.count() == 60


def test_duplicate_source_key(spark):
    t = spark.createDataFrame(TARGET, SCHEMA)
    s = spark.createDataFrame([(1, "x", 5), (1, "y", 6)], SCHEMA)
    with pytest.raises(Exception, match="several source rows for k = 1"):
        R.merge_upsert(t, s, "k").collect()
    assert (1, "y", 6) in rows(R.merge_upsert(t, s, "k", on_duplicate="latest", latest_by=["b"]))
    with pytest.raises(ValueError):
        R.merge_upsert(t, s, "k", on_duplicate="latest")


def test_newer_row_wins(spark):
    t = spark.createDataFrame([(1, "old", 5), (2, "old", 5)], SCHEMA)
    s = spark.createDataFrame([(1, "late", 4), (2, "same", 5)], SCHEMA)
    assert rows(R.merge_upsert(t, s, "k", newer_by="b")) == [(1, "old", 5), (2, "same", 5)]


def test_upsert_into_path_touches_only_its_buckets(spark, tmp_path):
    spec = ObjectSpec("thing", "k", {"k": "K", "a": "A", "b": "B"})
    path = str(tmp_path / "target")
    R.write_keyed(spark.createDataFrame([(i, "old", i) for i in range(100)] + [(None, "old", -1)], SCHEMA), path, "k", 8)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "target").rglob("*.parquet")}
    for _ in range(2):
        R.upsert_into_path(spark, path, spark.createDataFrame([(5, "new", 0), (500, "new", 1)], SCHEMA), spec)
    got = rows(spark.read.parquet(path).select("k", "a", "b"))
    want = [(i, "old", i) for i in range(100) if i != 5] + [(5, "new", 0), (500, "new", 1), (None, "old", -1)]
    assert got == sorted(want, key=repr)
    kept = [p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]]
    assert kept, "buckets without changed keys must stay as they are"


def test_stored_layout_rules(spark, tmp_path):
    path = str(tmp_path / "t")
    R.write_keyed(spark.createDataFrame([(i, "old", i) for i in range(20)], SCHEMA), path, "k", 4)
    R.upsert_into_path(spark, path, spark.createDataFrame([(i, "new", i) for i in range(20)], SCHEMA), ObjectSpec("t", "k", {"k": "K", "a": "A", "b": "B"}))
    assert spark.read.parquet(path).count() == 20
    with pytest.raises(ValueError, match="keyed by k"):
        R.upsert_into_path(spark, path, spark.createDataFrame([(1, "x", 1)], SCHEMA), ObjectSpec("t", "b", {"k": "K", "a": "A", "b": "B"}))


def test_many_equal_rows_without_key(spark):
    t = spark.createDataFrame(TARGET, SCHEMA)
    s = spark.range(5000).selectExpr("CAST(NULL AS LONG) AS k", "'n' AS a", "1L AS b")
    assert R.merge_upsert(t, s, "k").where("a = 'n'").count() == 5000


def test_reduction_needs_no_sorted_aggregate(spark):
    s = spark.createDataFrame([(1, "x", 5), (1, "y", 6)], SCHEMA)
    for how in ("error", "latest"):
        plan = R.one_row_per_key(s, "k", how, latest_by=["b"])._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan


def test_interrupted_publication_is_finished_by_the_next_run(spark, tmp_path):
    spec = ObjectSpec("thing", "k", {"k": "K", "a": "A", "b": "B"})
    path, stage = str(tmp_path / "target"), str(tmp_path / "stage")
    R.write_keyed(spark.createDataFrame([(i, "old", i) for i in range(40)], SCHEMA), path, "k", 4)
    R.upsert_into_path(spark, path, spark.createDataFrame([(5, "new", 0)], SCHEMA), spec, stage=stage)
    want = rows(spark.read.parquet(path).select("k", "a", "b"))
    touched = next(iter(spark.read.parquet(f"{stage}/merged").select("bucket").distinct().collect()))[0]
    shutil.rmtree(tmp_path / "target" / f"bucket={touched}")  # as if stopped between removing and replacing a bucket
    spark.createDataFrame([(path,)], "target string").write.mode("overwrite").parquet(f"{stage}/publishing")
    other = str(tmp_path / "other")
    R.write_keyed(spark.createDataFrame([(1, "old", 1)], SCHEMA), other, "k", 4)
    with pytest.raises(ValueError, match="unfinished publication"):
        R.upsert_into_path(spark, other, spark.createDataFrame([(6, "new", 0)], SCHEMA), spec, stage=stage)
    R.upsert_into_path(spark, path, spark.createDataFrame([(6, "new", 0)], SCHEMA), spec, stage=stage)
    got = rows(spark.read.parquet(path).select("k", "a", "b"))
    assert got == sorted([r for r in want if r[0] != 6] + [(6, "new", 0)], key=repr)


def test_publication(spark, tmp_path):
    df = spark.createDataFrame([(1, "p"), (2, "q")], "phone_oid long, phone_number string")
    for c in OBJECTS["phone"].columns:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    out = write_upsert_batch(df, "phone", "phone_oid", str(tmp_path), "b1")
    back = spark.read.parquet(out)
    assert back.columns[:2] == ["ID", "PhoneOID__c"] and back.count() == 2
    with pytest.raises(Exception, match="several source rows"):
        write_upsert_batch(df.union(df), "phone", "phone_oid", str(tmp_path), "b2")
    with pytest.raises(Exception, match="without phone_oid"):
        write_upsert_batch(df.withColumn("phone_oid", F.lit(None).cast("long")), "phone", "phone_oid", str(tmp_path), "b3")
    with pytest.raises(ValueError):
        write_upsert_batch(df, "phone", "entity_oid", str(tmp_path), "b4")


def test_registry_keys():
    assert len(PUBLISHED) == 13
    for name, key in PUBLISHED:
        assert OBJECTS[name].key == key and key in OBJECTS[name].fields
    for spec in OBJECTS.values():
        assert spec.key not in spec.update_columns and set(spec.update_columns) <= set(spec.columns)


def test_catalog_reads_any_spelling(spark, tmp_path):
    spark.createDataFrame([(1, 7, "x")], "ContractTermOid int, ContractOid int, Extra string").selectExpr(
        "*", "TIMESTAMP_NTZ'2024-01-01' AS StartDate", "TIMESTAMP_NTZ'2025-01-01' AS Maturity_Date", "0.05 AS internalYieldRate"
    ).write.parquet(str(tmp_path / "contract_term"))
    got = TableCatalog(spark, str(tmp_path)).read("contract_term")
    assert got.dtypes[0] == ("contract_term_oid", "bigint") and got.count() == 1 and "Extra" not in got.columns
    with pytest.raises(ValueError, match="missing columns"):
        TableCatalog(spark, str(tmp_path), {"contract": got}).read("contract")
    with pytest.raises(ValueError, match="crm_root"):
        TableCatalog(spark, str(tmp_path)).read("crm.contract")


def test_catalog_reads_csv(spark, tmp_path):
    spark.createDataFrame([("23", "Opportunity")], "Oid string, Descr string").write.option("header", "true").csv(str(tmp_path / "generic_field"))
    assert rows(TableCatalog(spark, str(tmp_path), fmt="csv").read("generic_field")) == [(23, "Opportunity")]


def test_inline_table(spark):
    assert vendor_rows()[0] == ("AK", "V04002") and vendor_rows()[-1] == ("WY", "V04052") and len(vendor_rows()) == 51
    assert inline_table(spark, [(1,)] * 10_001, "a int").count() == 10_001


def test_scratch_path_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    assert path.startswith(root or spark.conf.get("spark.checkpoint.dir"))
