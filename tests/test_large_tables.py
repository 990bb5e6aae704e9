"""What keeps the queries within bounds on large tables, on small rows."""

from __future__ import annotations

import time
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgersync.checks import change_checks
from ledgersync.checks.harness import AS_OF
from ledgersync.operators import aggregates as G
from ledgersync.operators import joins
from ledgersync.operators import sync as R
from ledgersync.plans import accounting, contracts, equipment, payments, schedules, tax
from ledgersync.registry import OBJECTS
from ledgersync.session import scratch_path, stored
from ledgersync.sources.folders import names_below
from ledgersync.sources.sink import write_upsert_batch
from ledgersync.sources.star import StarCatalog


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.mark.parametrize("options", [{}, {"staged": True}])
def test_rows_dropped_before_the_key_check_do_not_fail_it(spark, no_broadcast, options):
    left = spark.range(2000).selectExpr("id", "id % 50 AS g").groupBy("id").agg(F.max("g").alias("g"))
    right = spark.range(0, 2000, 2).selectExpr("id AS r", "id * 10 AS k").groupBy("r").agg(F.max("k").alias("k"))
    joined = left.join(right, F.col("id") == F.col("r"), "left").select("k", "g")
    once = R.one_row_per_key(joined.filter("k IS NOT NULL"), "k", "error", "error", **options)
    assert once.count() == 1000 and once.schema == joined.schema
    with pytest.raises(Exception, match="source row without k"):
        R.one_row_per_key(joined, "k", "error", "error", **options).count()


def test_merge_source_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def note(rows):
        for r in rows:
            seen.add(1)
            yield r

    source = spark.range(40).selectExpr("id AS k", "id * 2 AS b").rdd.mapPartitions(note).toDF("k long, b long")
    target = spark.createDataFrame([(1, 0), (99, 0)], "k long, b long")
    assert R.merge_upsert(target, source, "k").count() == 41
    assert seen.value == 40


def test_tax_rows_do_not_meet_by_an_empty_exception(spark, sf_dir, monkeypatch):
    real, met = tax.lookup, []
    monkeypatch.setattr(tax, "lookup", lambda base, dim, on, *args, **kw: met.append((on, base.columns)) or real(base, dim, on, *args, **kw))
    tax.tax_detail(StarCatalog(spark, sf_dir))
    by = [columns for on, columns in met if on == "tax_exception_oid"]
    assert by and not any("taxable_amount" in columns for columns in by)


def test_rows_of_unshared_keys_become_no_blocks(spark, monkeypatch):
    base, met = datetime(2000, 1, 1), []
    real = joins._block_pairs
    monkeypatch.setattr(joins, "_block_pairs", lambda ev, sp, hot: met.append((ev.count(), sp.count())) or real(ev, sp, hot))
    spans = spark.createDataFrame([(k, 10 * k, base, base + timedelta(days=800)) for k in range(10)] + [(None, 1, base, None)], "k long, c long, f timestamp_ntz, t timestamp_ntz")
    events = spark.createDataFrame([(i, i % 4 + 8 if i else None, base + timedelta(hours=i)) for i in range(40)], "id long, k long, at timestamp_ntz")
    got = joins.interval_join(events, spans, "k", "at", "f", "t", AS_OF)
    assert got.count() == 19 and met == [(19, 2)]  # keys 8 and 9


def test_stream_reads_account_ids_from_files(spark, sf_dir, monkeypatch):
    real, plans = change_checks.stream_balances, []
    monkeypatch.setattr(change_checks, "stream_balances", lambda stream, ids, *args: plans.append(plan_of(ids)) or real(stream, ids, *args))
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda df, n: (_ for _ in ()).throw(AssertionError("one task")) if "credit" in df.columns else df.repartition(n))
    change_checks._streamed_balances(StarCatalog(spark, sf_dir))
    assert len(plans) == 2 and not any("Aggregate" in p for p in plans)


@pytest.mark.parametrize(
    ("module", "build", "late"),
    [(equipment, equipment.equipment, "equipment_location"), (payments, payments.applied, "applied_to"), (schedules, schedules.scheduled_billables, "full_change")],
)
def test_opportunity_joins_while_rows_are_narrow(spark, sf_dir, monkeypatch, module, build, late):
    real, met = module.with_opportunity, []
    monkeypatch.setattr(module, "with_opportunity", lambda df, *args, **kw: met.append(df.columns) or real(df, *args, **kw))
    build(StarCatalog(spark, sf_dir))
    assert len(met) == 1 and late not in met[0]


def test_ledger_buckets_shuffle_narrow_rows(spark, sf_dir, no_broadcast):
    """Between the meeting with the account ids and the bucket sums lies no shuffle of partial sums of every bucket."""
    plan = plan_of(accounting.contract_ledger(StarCatalog(spark, sf_dir), AS_OF)).split("Initial Plan")[-1]
    shuffles = [line for line in plan.splitlines() if "hashpartitioning(contract_oid" in line]
    assert len(shuffles) == 1 and "REPARTITION_BY_COL" in shuffles[0]


def _collectors(spark, rows):
    spec = OBJECTS["collector"]
    return spark.createDataFrame([(k, *[text] * (len(spec.columns) - 1)) for k, text in rows], ", ".join(["contract_oid long", *[f"{c} string" for c in spec.columns[1:]]]))


def test_published_rows_are_written_once(spark, tmp_path):
    scratch = scratch_path(spark, "x").rsplit("/", 1)[0]
    before = names_below(spark, scratch, "upsert-source")
    out = write_upsert_batch(_collectors(spark, [(1, "a"), (2, "b")]), "collector", "contract_oid", str(tmp_path), "b1")
    assert spark.read.parquet(out).count() == 2 and names_below(spark, scratch, "upsert-source") == before
    assert names_below(spark, str(tmp_path / "object=collector"), "") == ["batch=b1"]


@pytest.mark.parametrize("bad", [[(1, "c"), (1, "d")], [(None, "c")]])
def test_refused_batch_leaves_the_one_before(spark, tmp_path, bad):
    out = write_upsert_batch(_collectors(spark, [(1, "a"), (2, "b")]), "collector", "contract_oid", str(tmp_path), "b1")
    with pytest.raises(Exception, match="source row"):
        write_upsert_batch(_collectors(spark, bad), "collector", "contract_oid", str(tmp_path), "b1")
    assert spark.read.parquet(out).count() == 2 and names_below(spark, str(tmp_path / "object=collector"), "") == ["batch=b1"]
    write_upsert_batch(_collectors(spark, [(3, "a")]), "collector", "contract_oid", str(tmp_path), "b1")
    assert spark.read.parquet(out).count() == 1


def test_stored_rows_give_back_their_shuffles(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    before = files()
    assert len(stored(spark.range(1000).repartition(4, "id"), "given-back").collect()) == 1000  # which shuffles nothing itself
    until = time.time() + 20
    while (left := files() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


@pytest.mark.parametrize("on_null_key", ["insert", "error"])
def test_failing_key_check_shuffles_rows_once(spark, no_broadcast, on_null_key):
    source = spark.createDataFrame([(i, i * 2) for i in range(100)], "k long, b long")
    plan = plan_of(R.one_row_per_key(source, "k", "error", on_null_key))
    assert plan.count("Exchange hashpartitioning") == 1
    target = spark.createDataFrame([(1, 0), (None, 0)], "k long, b long")
    if on_null_key == "insert":
        assert plan_of(R.merge_upsert(target, source, "k")).count("Exchange hashpartitioning") == 2
        keyless = source.unionByName(spark.createDataFrame([(None, 7), (None, 7)], "k long, b long"))
        assert R.merge_upsert(target, keyless, "k").count() == 103


def test_wide_columns_of_a_party_join_last(spark, sf_dir, monkeypatch):
    real, met = contracts.with_opportunity, []
    monkeypatch.setattr(contracts, "with_opportunity", lambda df, *args, **kw: met.append(df.columns) or real(df, *args, **kw))
    contracts.customers(StarCatalog(spark, sf_dir))
    assert len(met) == 1 and "legal_name" not in met[0] and "entity_oid" in met[0]


def test_lines_are_laid_out_by_invoice_once(spark, sf_dir, no_broadcast):
    cat = StarCatalog(spark, sf_dir)
    oldest = G.oldest_unpaid_by(cat.read("invoice_detail"), cat.read("invoice_payment_history"), AS_OF, {"due": G.CLOSED_STATES})
    plan = plan_of(oldest).split("Initial Plan")[-1]
    assert plan.count("hashpartitioning(contract_oid") == 2  # by invoice, then the dates of its contract


@pytest.mark.parametrize("told", [True, False])
def test_packed_ledger_codes_give_the_same_sums(spark, told):
    accounts, processes = [None, "01-10089", "01-10090", "01-10130", "99"], [None, 20119, 20141, 20143, 7]
    times = [None, datetime(1999, 1, 1), datetime(2001, 1, 1)]
    cells = [(a, p, t) for a in accounts for p in processes for t in times]
    gl = spark.createDataFrame(
        [(i % 6 if i % 31 else None, a, p, t, Decimal(10**i % 1009) if i % 3 else None, Decimal(-i) if i % 5 else None) for i, (a, p, t) in enumerate(cells * 2)],
        "general_ledger_account_id_oid long, account_id string, process_oid long, post_date timestamp_ntz, debit decimal(18,2), credit decimal(18,2)",
    )
    ids = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, None), (4, 3), (5, 4)], "general_ledger_account_id_oid long, contract_oid long")
    buckets = [*G.snapshot_buckets("posted"), *G.termination_buckets()]
    if not told:
        buckets.append(G.Bucket("untold", "account_id = '99' OR process_oid = 7"))
    posted = f"post_date <= TIMESTAMP_NTZ'{AS_OF}'"
    reduced = G.ledger_buckets(gl, ids, buckets, {"posted": posted}, {"n": "posted"})
    rows = gl.withColumn("posted", F.expr(posted)).join(ids.dropna(), "general_ledger_account_id_oid")
    want = G.bucket_sums(rows, ["contract_oid"], G.LEDGER_AMOUNT, buckets, F.expr("COALESCE(SUM(CASE WHEN posted THEN 1 END), 0) AS n"))
    assert sorted(map(str, reduced.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    shuffled = [x.split("hashpartitioning(")[1] for x in plan_of(reduced).splitlines() if "hashpartitioning(general_ledger_account_id_oid" in x]
    assert any(" account_id#" in x for x in shuffled) is not told


def test_only_streams_of_wanted_schedules_are_summed(spark, sf_dir, monkeypatch, no_broadcast):
    cat, real, met = StarCatalog(spark, sf_dir), schedules.schedule_rollup, []
    monkeypatch.setattr(schedules, "schedule_rollup", lambda streams, *args: met.append(streams) or real(streams, *args))
    out = schedules.scheduled_billables(cat)
    wanted, every = out.select("schedule_definition_oid").distinct(), cat.read("payment_stream")
    assert met[0].count() == every.join(wanted, "schedule_definition_oid", "left_semi").count() < every.count()
    plan = plan_of(out).split("Initial Plan")[-1]
    for key in ("payment_stream_oid", "schedule_definition_oid"):  # narrow rows, no partial sums
        assert any(f"hashpartitioning({key}" in x and "REPARTITION_BY_COL" in x for x in plan.splitlines())
