"""Change propagation, maintained sums, digests, bitmaps and batches on small rows, against brute force and by their plans."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_operators import rows, spans_and_events
from test_plans import plan_of

from ledgersync.checks.harness import AS_OF, END, JOURNAL_MONTH, START
from ledgersync.functions.clock import Window
from ledgersync.operators import affected, bitmaps, joins, sync, windows
from ledgersync.operators.digests import snapshot_diff_stored, write_digests
from ledgersync.operators.ledger_sums import LedgerSums, ledger_series, reduced_from_sums
from ledgersync.plans import accounting, equipment, journal, schedules
from ledgersync.registry import OBJECTS, ObjectSpec
from ledgersync.session import stored
from ledgersync.sources.folders import names_below
from ledgersync.sources.pull import pull_changes, store_watermark, watermark
from ledgersync.sources.sink import write_quarantined
from ledgersync.sources.star import StarCatalog
from ledgersync.streaming import balances as kept

WEEK = Window.of("1998-03-02 00:00:00", "1998-03-04 00:00:00")


# --- numbering and intervals --------------------------------------------------------------


@pytest.fixture
def apart(spark):
    """Keeps small partitions apart, which would be put together otherwise."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_huge_part_is_numbered_by_many_tasks(spark, apart):
    df = spark.range(20_000).selectExpr("IF(id < 19990, 1, id % 3) AS j", "IF(id % 7 = 0, NULL, id % 50) AS d", "id AS k").repartition(6)
    got = windows.number_lines(df, "j", ["d", "k"])
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r.j, r.d is not None, r.d or 0, r.k)):
        want.setdefault(r.j, []).append(r.k)
    lines = {(r.j, r.line_no): r.k for r in got.collect()}
    assert lines == {(j, n): k for j, ks in want.items() for n, k in enumerate(ks, 1)}
    laid = stored(windows.ordered_within(df, "j", ["d", "k"]).withColumn("p", F.spark_partition_id()), "t")
    assert laid.where("j = 1").select("p").distinct().count() > 1


def test_journal_export_scans_the_ledger_once(spark, sf_dir, monkeypatch):
    plans = []
    real = windows.stored
    monkeypatch.setattr(windows, "stored", lambda df, name: plans.append(plan_of(df)) or real(df, name))
    out = plan_of(journal.journal_export(StarCatalog(spark, sf_dir), JOURNAL_MONTH))
    scans = [line for plan in [*plans, out] for line in plan.splitlines() if "FileScan" in line and "l_extendedprice" in line]
    assert len(plans) == 1 and len(scans) == 1


@pytest.mark.parametrize("hot", [3, 50, 100_000])
def test_interval_join_in_parts(spark, hot):
    spans, events = spans_and_events(7)
    as_of = datetime(2002, 6, 1, 9)
    s = spark.createDataFrame(spans, "k long, c long, start_date timestamp_ntz, end_date timestamp_ntz")
    e = spark.createDataFrame(events, "id long, k long, at timestamp_ntz")
    want = [(i, k, at, c, lo, hi) for i, k, at in events for sk, c, lo, hi in spans if sk == k and lo <= at <= (hi or as_of)]
    got = joins.interval_join(e, s, "k", "at", "start_date", "end_date", as_of, hot)
    assert rows(got) == sorted(want, key=repr) and got.columns == ["id", "k", "at", "c", "start_date", "end_date"]


def test_interval_join_compares_about_its_result(spark):
    base = datetime(2000, 1, 1)
    s = spark.createDataFrame([(1, i, base + timedelta(days=3 * i, hours=5), base + timedelta(days=3 * i + 2, hours=7)) for i in range(500)], "k long, c long, f timestamp_ntz, t timestamp_ntz")
    e = spark.createDataFrame([(i, 1, base + timedelta(hours=18 * i)) for i in range(2000)], "id long, k long, at timestamp_ntz")
    n = joins.interval_join(e, s, "k", "at", "f", "t", AS_OF).count()
    ev = e.select(F.struct("id").alias("__event"), F.col("k").alias("__key"), F.col("at").alias("__at"))
    met = joins._block_pairs(ev, s.select(F.col("k").alias("__key"), F.col("f").alias("__from"), F.col("t").alias("__to")), 1000).count()
    assert 0 < n <= met < 2 * n < 2000 * 500 / 100


# --- affected keys ------------------------------------------------------------------------


def _groupings_of_whole_scans(df) -> list[str]:
    """Aggregations and windows of the optimised plan with a leaf below them that no semi join or filter on ids cuts."""
    found = []

    def leaves(node, cut):
        name = node.nodeName()
        children = node.children()
        kids = [children.apply(i) for i in range(children.size())]
        if not kids:
            return [] if cut or name.startswith("LocalRelation") else [node.toString()[:120]]
        if name == "Join" and node.joinType().toString() == "LeftSemi":
            return leaves(kids[0], True)
        return [leaf for k in kids for leaf in leaves(k, cut)]

    def walk(node):
        if node.nodeName() in ("Aggregate", "Window"):
            found.extend(leaves(node, False))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().optimizedPlan())
    return found


class Plain(StarCatalog):
    """The lease tables as files of their own; the views over the star tables group rows themselves."""

    def _declared(self, name):
        return stored(super()._declared(name), name)


def test_listed_equipment_is_joined_up_once(spark, sf_dir, monkeypatch):
    names, real = [], equipment.stored
    monkeypatch.setattr(equipment, "stored", lambda df, name: names.append((name, df.columns)) or real(df, name))
    plan = plan_of(equipment.equipment_changes(StarCatalog(spark, sf_dir), WEEK))
    assert "l_partkey" not in plan  # of the serial numbers, which the stored rows hold
    held = dict(names)
    assert {"serial_number", "contract_item_oid"} <= set(held["equipment-rows"]) and "bill_to_location_oid" not in held["equipment-rows"]


@pytest.mark.parametrize("build", [schedules.scheduled_billables_changes, schedules.total_payments_changes, equipment.equipment_changes])
def test_changes_group_only_affected_rows(spark, sf_dir, build):
    codes = ("data_value", "table_key")  # the code table
    assert [leaf for leaf in _groupings_of_whole_scans(build(Plain(spark, sf_dir), WEEK)) if not any(c in leaf for c in codes)] == []
    assert _groupings_of_whole_scans(equipment.equipment(Plain(spark, sf_dir))) != []


@pytest.mark.parametrize(
    "build,full,key,keys",
    [
        (schedules.scheduled_billables_changes, schedules.scheduled_billables, "schedule_definition_oid", lambda c, w: schedules.affected_schedules(c, w, contracts=True)),
        (equipment.equipment_changes, equipment.equipment, "equipment_oid", equipment.affected_equipment),
    ],
)
def test_changes_equal_the_full_run_on_affected_keys(spark, sf_dir, build, full, key, keys):
    cat = StarCatalog(spark, sf_dir)
    whole, at = rows(full(cat)), full(cat).columns.index(key)
    for window in (WEEK, Window.of("1900-01-01 00:00:00", "1900-01-02 00:00:00"), Window.of("1900-01-01 00:00:00", "2100-01-01 00:00:00")):
        wanted = {r[0] for r in keys(cat, window).collect()}
        assert rows(build(cat, window)) == [r for r in whole if r[at] in wanted]


def test_keys_travel_against_the_flow(spark):
    a = spark.createDataFrame([(1, datetime(2024, 1, 2)), (2, datetime(2023, 1, 1)), (None, datetime(2024, 1, 2)), (3, None)], "x long, at timestamp_ntz")
    ab = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (None, 13)], "x long, y long")
    bc = spark.createDataFrame([(10, 7), (11, 7), (12, 8), (13, 9), (11, None)], "y long, z long")
    found = affected.affected_keys([affected.Contribution(a, "at", "x", [affected.Hop(ab, "x", "y"), affected.Hop(bc, "y", "z")])], Window.of("2024-01-01 00:00:00", "2024-02-01 00:00:00"), "z")
    assert rows(found) == [(7,)]


# --- maintained sums ----------------------------------------------------------------------


def _ledger(rng, n, first=0):
    base = datetime(2023, 11, 20)
    return [
        (first + i, rng.randrange(6), None, rng.choice(["01-10089", "01-10090", "01-10092", "x"]), rng.choice([20119, 20143, 7]), 1,
         None if rng.random() < 0.05 else base + timedelta(hours=rng.randrange(24 * 90)), rng.choice([None, "1.50", "20.00"]), rng.choice([None, "-3.25"]))
        for i in range(n)
    ]


_GL = (
    "general_ledger_oid bigint, general_ledger_account_id_oid bigint, general_ledger_reference_oid bigint, account_id string, process_oid bigint,"
    " journal_number bigint, post_date timestamp_ntz, debit string, credit string"
)


def _frame(spark, ledger):
    return spark.createDataFrame(ledger, _GL).withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("debit", "credit")})


@pytest.mark.parametrize("seed", [1, 2])
def test_sums_equal_the_full_scan_after_any_order(spark, tmp_path, seed, monkeypatch):
    rng = random.Random(seed)
    ledger = _ledger(rng, 120)
    sums = LedgerSums(spark, str(tmp_path / "sums"))
    assert sums.sums().count() == 0
    pieces = [ledger[i::5] for i in range(5)]
    order = [*range(5), 1, 3]  # two batches come again under their names
    rng.shuffle(order)
    for step, k in enumerate(order):
        sums.add(_frame(spark, pieces[k]), f"batch {k}")
        if rng.random() < 0.5:
            sums.fold()
        if step == 3:
            sums.add(_frame(spark, ledger[:30]), "taken back", sign=-1)
    sums.add(_frame(spark, ledger[:30]), "again")
    ids = spark.createDataFrame([(i, 100 + i // 2, 1) for i in range(5)] + [(5, None, 1)], "general_ledger_account_id_oid bigint, contract_oid bigint, gl_accounts_oid bigint")
    contracts = spark.createDataFrame([(100,), (101,), (102,)], "contract_oid bigint")

    class Catalog:
        def read(self, name):
            return {"general_ledger": _frame(spark, ledger), "general_ledger_account_id": ids}[name]

    for as_of in ("2023-12-31 23:00:00", "2024-01-01 00:00:00", "2024-01-17 05:00:00", "2025-01-01 00:00:00", "2020-01-01 00:00:00"):
        full = rows(accounting.contract_ledger(Catalog(), as_of))
        assert rows(accounting.contract_ledger(Catalog(), as_of, contracts, sums.sums())) == full
    scan = reduced_from_sums(sums.sums(), _frame(spark, ledger), "2024-01-17 05:00:00")
    assert scan.where("posted").count() > 0


def test_a_stopped_fold_changes_nothing(spark, tmp_path, monkeypatch):
    ledger = _ledger(random.Random(3), 40)
    path = str(tmp_path / "sums")
    sums = LedgerSums(spark, path)
    for k in range(4):
        sums.add(_frame(spark, ledger[10 * k : 10 * k + 10]), str(k))
        if k == 1:
            want = rows(sums.sums())
            with monkeypatch.context() as m:
                m.setattr(LedgerSums, "_manifest", lambda self: (_ for _ in ()).throw(RuntimeError("stopped")))
                with pytest.raises(RuntimeError):
                    sums.fold()
            spark.createDataFrame([], "base string, folded array<string>").write.parquet(f"{path}/manifests/turn=1")  # its manifest is there but empty
            assert rows(sums.sums()) == want
        if k > 1:
            sums.fold()
    whole = LedgerSums(spark, str(tmp_path / "whole"))
    whole.add(_frame(spark, ledger), "all")
    assert rows(sums.sums()) == rows(whole.sums())
    assert len(names_below(spark, f"{path}/batches", "batch=")) == 1 and len(names_below(spark, path, "base-")) == 2  # older ones are gone


def test_series_equals_single_dates(spark):
    ledger = _ledger(random.Random(4), 200)
    ids = spark.createDataFrame([(i, 100 + i // 2, 1) for i in range(6)], "general_ledger_account_id_oid bigint, contract_oid bigint, gl_accounts_oid bigint")
    dates = ["2023-11-01 00:00:00", "2023-12-01 00:00:00", "2023-12-01 07:00:00", "2024-01-10 00:00:00", "2024-01-10 00:00:00", "2024-12-31 00:00:00"]
    got = rows(ledger_series(_frame(spark, ledger), ids, dates))
    from ledgersync.operators.aggregates import ledger_snapshot

    want = [(datetime.fromisoformat(d), *r) for d in sorted(set(dates)) for r in rows(ledger_snapshot(_frame(spark, ledger), ids, d))]
    assert got == sorted(want, key=repr) and want
    plan = plan_of(ledger_series(StarCatalog(spark, "/root/testdata/sf0.001").read("general_ledger"), ids, dates))
    assert sum("FileScan" in line and "l_extendedprice" in line for line in plan.splitlines()) == 1


def test_codes_outside_the_buckets_fall_together(spark, sf_dir):
    cat = StarCatalog(spark, sf_dir)
    plan = plan_of(accounting.contract_ledger(cat, AS_OF))
    assert "20120" not in plan.split("HashAggregate")[-1] and "IF" in plan.upper() and "Sort Aggregate" not in plan


def test_stream_of_balances_survives_restarts(spark, tmp_path):
    from ledgersync.operators.aggregates import bucket_sums, snapshot_buckets
    from ledgersync.streaming.upsert import change_stream

    buckets, ddl = snapshot_buckets(), "general_ledger_account_id_oid bigint, account_id string, process_oid bigint, debit decimal(18,2), credit decimal(18,2)"
    ids = spark.createDataFrame([(i, 100 + i // 2, 1) for i in range(5)], "general_ledger_account_id_oid bigint, contract_oid bigint, gl_accounts_oid bigint")
    target, ledger = str(tmp_path / "target"), _ledger(random.Random(6), 90)
    kept.empty_balances(spark, target, buckets, 4)
    columns = [c.split()[0] for c in ddl.split(", ")]
    for step in range(3):
        for k in range(2):
            part = ledger[30 * step + 15 * k : 30 * step + 15 * k + 15]
            _frame(spark, part).select(*columns).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{step}{k}"))
        stream = change_stream(spark, str(tmp_path / "in" / "*"), ddl, files_per_trigger=1)
        kept.stream_balances(stream, ids, buckets, target, str(tmp_path / "checkpoint")).awaitTermination()
        seen = _frame(spark, ledger[: 30 * step + 30]).join(ids, "general_ledger_account_id_oid")
        want = bucket_sums(seen, ["contract_oid"], "COALESCE(debit, 0) + COALESCE(credit, 0)", buckets)
        assert rows(kept.current_balances(spark, target, buckets)) == rows(want)


# --- digests, bitmaps, batches ------------------------------------------------------------


def test_digests_label_as_the_whole_comparison_does(spark, tmp_path):
    rng = random.Random(8)
    old = [(i, rng.choice([None, 1, 2]), rng.choice([None, 5, 6])) for i in range(400)]
    new = [(i, (a or 0) + 1 if i % 40 == 3 else a, None if i % 80 == 5 else b) for i, a, b in old if i != 17] + [(1000, 1, 1), (1001, None, None)]
    path = str(tmp_path / "copy")
    stored_rows = spark.createDataFrame(old, "k long, a long, b long")
    sync.write_keyed(stored_rows, path, "k", 128)
    measures = ["a", ("a", "b")]
    write_digests(spark, path, "k", measures)
    current = spark.createDataFrame(new, "k long, a int, b int").withColumn("other", F.lit("x"))
    for options in ({}, {"null_safe": True, "new_rows": True}):
        want = sync.snapshot_diff(current, stored_rows, "k", measures, **options)
        got = snapshot_diff_stored(current, path, "k", measures, **options)
        assert rows(got.select(*want.columns)) == rows(want)
    plan = plan_of(got)
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "/copy" in line)
    touched = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in touched
    same = snapshot_diff_stored(stored_rows, path, "k", measures)
    assert {r.change_status for r in same.collect()} == {"No Changes"}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_bitmap_split_equals_member_split(spark, limit):
    rng = random.Random(9)
    keys = spark.createDataFrame([(k,) for k in [None, 0, 1, -1, -40_000, 32_768, 32_769, 2**40, *(rng.randrange(-70_000, 70_000) for _ in range(3_000))]] * 2, "k long")
    df = spark.createDataFrame([(k, str(k)) for k in [None, 2**40, 2**40 + 1, *range(-70_000, 70_000, 7)]], "id long, t string")
    got, want = bitmaps.member_split_bitmap(df, "id", keys, limit), joins.member_split(df, "id", keys)
    for g, w in zip(got, want, strict=True):
        assert rows(g) == rows(w)
    if limit:
        plan = plan_of(got[0])
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_quarantine_keeps_every_row(spark, tmp_path):
    spec = OBJECTS["collector"]
    full = [(i if i else None, *["x"] * (len(spec.columns) - 1)) for i in (1, 2, 2, 3, 0, 0, 4)]
    order = [spec.key, *[c for c in spec.columns if c != spec.key]]
    df = spark.createDataFrame(full, ", ".join(f"{c} {'long' if c == spec.key else 'string'}" for c in order))
    for _ in range(2):  # writing again replaces
        batch = write_quarantined(df, "collector", spec.key, str(tmp_path), "b1")
        assert (batch.n_accepted, batch.n_rejected) == (3, 4)
        name = spec.fields[spec.key]
        assert {r[name] for r in spark.read.parquet(batch.accepted).collect()} == {1, 3, 4}
        bad = spark.read.parquet(batch.rejected).select(name, "reason")
        assert rows(bad) == sorted([(2, "repeated key")] * 2 + [(None, "no key")] * 2, key=repr)
    clean = write_quarantined(df.where(f"{spec.key} = 1"), "collector", spec.key, str(tmp_path), "b2")
    assert (clean.n_accepted, clean.n_rejected) == (1, 0)
    assert write_quarantined(df.limit(0), "collector", spec.key, str(tmp_path), "b3").n_accepted == 0
    with pytest.raises(ValueError, match="keyed by"):
        write_quarantined(df, "collector", "nothing", str(tmp_path), "b1")


STATE = ObjectSpec("state", "k", {"k": "K", "v": "V", "ts": "T"})
DDL = "k long, v long, ts timestamp_ntz"


def _at(day):
    return datetime(2024, 1, 1) + timedelta(days=day)


def test_only_unmerged_batches_are_opened(spark, tmp_path):
    from ledgersync.streaming.upsert import empty_target

    path = str(tmp_path / "target")
    empty_target(spark, path, DDL, "k", 2)
    opened = lambda: {f.split("/batch=")[1].split("/")[0] for f in sync.keyed_state(spark, path, STATE, DDL, ["ts"]).inputFiles() if "-changes/batch=" in f}
    there = lambda: names_below(spark, f"{path}-changes", "batch=")
    for turn in range(4):
        for k in range(2):
            sync.append_changes(spark.createDataFrame([(turn, 10 * turn + k, _at(turn)), (None, k, _at(turn))], DDL), path, STATE, f"{turn}.{k}", ["ts", "v"], on_null_key="insert")
        assert len(opened()) == 2
        sync.compact(spark, path, STATE, ["ts", "v"])
        assert len(there()) == 2  # of this round; those of earlier rounds are removed
        got = rows(sync.keyed_state(spark, path, STATE, DDL, ["ts", "v"]))
        assert got == sorted([(t, 10 * t + 1, _at(t)) for t in range(turn + 1)] + [(None, k, _at(t)) for t in range(turn + 1) for k in range(2)], key=repr)
    sync.compact(spark, path, STATE, ["ts", "v"])
    assert there() == []
    assert rows(sync.keyed_state(spark, path, STATE, DDL, ["ts", "v"])) == got


def test_interrupted_and_repeated_pulls_equal_one(spark, tmp_path, monkeypatch):
    from ledgersync.sources import pull
    from ledgersync.streaming.upsert import empty_target

    source = spark.createDataFrame([(i % 20, i, _at(i / 4)) for i in range(100)] + [(99, 1, None)], DDL)
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    for p in (one, many):
        empty_target(spark, p, DDL, "k", 2)
    pull_changes(source, one, STATE, "ts", _at(20), timedelta(days=1))
    for until in (3, 9, 9, 14, 20):
        if until == 14:
            with monkeypatch.context() as m:
                m.setattr(pull, "store_watermark", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
                with pytest.raises(RuntimeError):
                    pull_changes(source, many, STATE, "ts", _at(until), timedelta(days=1))
            assert watermark(spark, many) == _at(9)
        pull_changes(source, many, STATE, "ts", _at(until), timedelta(days=1))
    assert not pull_changes(source, many, STATE, "ts", _at(20), timedelta(days=1))
    state = lambda p: rows(sync.keyed_state(spark, p, STATE, DDL, ["ts"]))
    assert state(one) == state(many) and len(state(one)) == 20
    store_watermark(spark, one, _at(21))
    assert watermark(spark, one) == _at(21)


def test_windows_are_closed():
    assert Window.of(START, END).start < Window.of(START, END).end
