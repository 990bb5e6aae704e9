"""Comments routed to contracts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.functions.clock import Window
from ledgersync.functions.predicates import changed_between, require
from ledgersync.operators.joins import interval_join, interval_min, lookup, member_split
from ledgersync.operators.sets import union_arms
from ledgersync.plans.common import with_opportunity
from ledgersync.registry import OBJECTS
from ledgersync.sources.catalog import TableCatalog

# Fixed value: comments filed on the account instead of a contract.
ACCOUNT_REF = "ACCT"


def multi_deal_entities(contracts: DataFrame, threshold: int = 1) -> DataFrame:
    """Entities with more than ``threshold`` contracts (replaces a hand-kept id list)."""
    counts = contracts.filter(F.col("entity_oid").isNotNull()).groupBy("entity_oid").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > threshold).select("entity_oid")


def notes(
    cat: TableCatalog,
    as_of: str | datetime,
    window: Window | None = None,
    multi_deal: DataFrame | None = None,
    threshold: int = 1,
    active_only: bool = True,
) -> DataFrame:
    """Contract comments, and account comments on the contract that was open when they were written.

    Account comments of multi-deal entities go to the least such contract; those
    of the other entities to every such contract, of which they have at most
    ``threshold`` unless a ``multi_deal`` list says otherwise.
    """
    all_contracts = cat.read("contract")
    contracts = all_contracts.filter(F.col("is_terminated") == 0) if active_only else all_contracts
    comments = require(changed_between(cat.read("comment"), "last_change_datetime", window), "text")
    filed = comments.filter(F.col("ref_type") != ACCOUNT_REF)
    own = lookup(filed, contracts, [("ref_oid", "contract_oid")], {"contract_oid": "contract_oid", "entity_oid": "entity_oid"}, "inner")

    term = cat.read("contract_term").select("contract_oid", "start_date")
    spans = contracts.join(term, "contract_oid").select(
        "entity_oid", "contract_oid", "contract_id", "start_date", "termination_date"
    )
    spans = spans.filter(F.col("contract_id").isNotNull())
    entities = cat.read("entity").select(F.col("oid").alias("ref_oid"))
    account = comments.filter(F.col("ref_type") == ACCOUNT_REF).join(entities, "ref_oid", "left_semi")
    account = account.withColumn("entity_oid", F.col("ref_oid"))
    listed = multi_deal_entities(all_contracts, threshold) if multi_deal is None else multi_deal
    multi, single = member_split(account, "entity_oid", listed)
    single_spans = interval_join(
        single, spans.select("entity_oid", "contract_oid", "start_date", "termination_date"), "entity_oid", "create_datetime",
        "start_date", "termination_date", as_of,
    ).drop("start_date", "termination_date")
    multi_spans = interval_min(
        multi, spans, "entity_oid", "create_datetime", "start_date", "termination_date", ["contract_oid"], "oid", as_of
    )
    arms = union_arms(own, single_spans.select(*own.columns), multi_spans.select(*own.columns))
    out = with_opportunity(arms, cat).withColumnRenamed("oid", "comment_oid")
    return out.select(*OBJECTS["notes"].columns)
