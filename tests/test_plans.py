"""Shape of the physical plans, and behaviour under a hot key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from ledgersync.checks import registered
from ledgersync.checks.harness import AS_OF
from ledgersync.plans import accounting, notes
from ledgersync.sources.star import StarCatalog, missing_views


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in registered() if n not in ("t01_stream_upsert", "t01_stream_late_files", "r03_bucketed_upsert", "s05_upsert_batch", "p23_published_batches")])
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(entry_module.queries()[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas"):
        assert word not in plan, word


def test_ledger_is_scanned_once(spark, sf_dir):
    plan = plan_of(accounting.contract_ledger(StarCatalog(spark, sf_dir), AS_OF))
    assert sum("FileScan" in line and "l_extendedprice" in line for line in plan.splitlines()) == 1


def test_date_filter_reaches_the_scan(spark, sf_dir):
    q = entry_module.queries()["f09_month_filter"](spark, sf_dir)
    scan = next(line for line in plan_of(q).splitlines() if "FileScan" in line)
    assert "GreaterThan(l_shipdate" in scan and "LessThanOrEqual(l_shipdate" in scan and "l_comment" not in scan


def test_all_lease_tables_have_views():
    assert missing_views() == set()


def test_hot_entity_keeps_all_notes(spark, sf_dir):
    """All contracts and account comments on one entity: each comment still lands once."""
    cat = StarCatalog(spark, sf_dir)
    hot = StarCatalog(
        spark,
        sf_dir,
        {
            "contract": cat.read("contract").withColumn("entity_oid", F.lit(5).cast("long")),
            "generic_value": cat.read("contract").selectExpr("23 AS genf_oid", "contract_oid AS ref_oid", "'O' AS field_value"),
            "comment": cat.read("comment").withColumn("ref_oid", F.when(F.col("ref_type") == "ACCT", 5).otherwise(F.col("ref_oid"))),
        },
    )
    out = notes.notes(hot, AS_OF).filter(F.col("ref_type") == "ACCT")
    spans = (
        hot.read("contract").filter("is_terminated = 0").join(hot.read("contract_term"), "contract_oid")
        .withColumn("to_date", F.coalesce("termination_date", F.expr(f"TIMESTAMP_NTZ'{AS_OF}'")))
    )
    c = hot.read("comment").filter("ref_type = 'ACCT' AND text IS NOT NULL")
    want = (
        c.join(spans, (c.ref_oid == spans.entity_oid) & c.create_datetime.between(spans.start_date, spans["to_date"]))
        .groupBy(c.oid).agg(F.min(spans.contract_oid).alias("least"))
    )
    got = sorted(tuple(r) for r in out.select("comment_oid", "entity_oid").collect())
    assert got == sorted((r.oid, 5) for r in want.collect()) and got
