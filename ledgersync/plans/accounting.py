"""Contract balances, net investment and days past due, now and at termination."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.functions.clock import ts, ts_sql
from ledgersync.functions.predicates import contract_scope
from ledgersync.functions.scalar import days_past_due, default, net_investment
from ledgersync.operators.affected import only
from ledgersync.operators.aggregates import (
    CLOSED_STATES,
    GROSS_ACCOUNT,
    NARROW_GROSS_PROCESSES,
    TERMINATED_EXCLUDED_STATES,
    TERMINATION_GROSS_PROCESSES,
    TERMINATION_PROCESS,
    gross_bucket,
    ledger_buckets,
    ledger_snapshot,
    oldest_unpaid_by,
    snapshot_buckets,
    spread_buckets,
    termination_buckets,
)
from ledgersync.operators.ledger_sums import ledger_series, reduced_from_sums
from ledgersync.operators.sync import CHANGED, snapshot_diff
from ledgersync.plans.common import with_opportunity
from ledgersync.registry import OBJECTS
from ledgersync.sources.catalog import TableCatalog

# Measures whose change makes a contract part of the incremental batch; the pair is compared as a difference.
TRACKED = (
    "gross_receivable",
    "original_gross_receivable",
    ("gross_receivable", "balance_remaining"),
    "balance_remaining",
    "unearned_finance",
    "residual",
    "deferred_residual",
    "deferred_expense",
    "security_deposit",
)

_TERMS = ("balance_remaining", "unearned_finance", "residual", "deferred_residual", "deferred_expense", "security_deposit")


def contract_ledger(cat: TableCatalog, as_of: str | datetime, scope: DataFrame | None = None, sums: DataFrame | None = None) -> DataFrame:
    """Balances at ``as_of`` and at termination, from a single ledger scan.

    ``scope`` lists the contracts wanted: the account ids, and so the reduced ledger, are cut to theirs. With ``sums``
    (``LedgerSums.sums``) only the open month is read from the ledger.
    """
    posted, at_term = f"post_date <= {ts_sql(as_of)}", (*TERMINATION_GROSS_PROCESSES, TERMINATION_PROCESS)
    account_ids = only(cat.read("general_ledger_account_id"), scope, "contract_oid")
    buckets, counts = [*snapshot_buckets("posted"), *termination_buckets()], {"posted_rows": "posted"}
    if sums is None:
        gl = cat.read("general_ledger").filter(f"{posted} OR process_oid IN {at_term}")
        out = ledger_buckets(gl, account_ids, buckets, {"posted": posted}, counts)
    else:
        reduced = reduced_from_sums(sums, cat.read("general_ledger"), as_of).filter(f"posted OR process_oid IN {at_term}")
        out = spread_buckets(reduced, account_ids, buckets, counts)
    # The original gross is 0, not NULL, for a contract with any posted row.
    original = F.when(F.col("posted_rows") > 0, F.coalesce("original_gross_receivable", F.lit(0)))
    return out.withColumn("original_gross_receivable", original)


def days_due(cat: TableCatalog, as_of: str | datetime, contracts: DataFrame) -> DataFrame:
    """Days past due of active contracts, and at termination of terminated ones."""
    rules = {"due_now": CLOSED_STATES, "due_term": TERMINATED_EXCLUDED_STATES}
    oldest = oldest_unpaid_by(cat.read("invoice_detail"), cat.read("invoice_payment_history"), as_of, rules)
    out = contracts.join(oldest, "contract_oid", "left")
    active, ended = F.col("is_terminated") == 0, F.col("is_terminated") == 1
    return out.withColumn("dpd", default(F.when(active, days_past_due("due_now", ts(as_of))), 0)).withColumn(
        "dpd_at_termination", default(F.when(ended, days_past_due("due_term", "termination_date")), 0)
    )


def accounting_snapshot(cat: TableCatalog, as_of: str | datetime, sums: DataFrame | None = None) -> DataFrame:
    """One row per booked company contract with an opportunity, measures as computed (NULLs kept)."""
    contracts = contract_scope(cat.read("contract")).select("contract_oid", "is_terminated", "termination_date")
    base = with_opportunity(contracts, cat).join(contract_ledger(cat, as_of, contracts, sums), "contract_oid", "left")
    base = days_due(cat, as_of, base)
    active, ended = F.col("is_terminated") == 0, F.col("is_terminated") == 1
    term_gross, term_balance = default("term_gross_receivable", 0), default("term_balance_remaining", 0)
    return base.select(
        "contract_oid",
        "opportunity",
        "gross_receivable",
        "original_gross_receivable",
        (F.col("gross_receivable") - F.col("balance_remaining")).alias("payments_made"),
        *_TERMS,
        F.when(active, net_investment(*_TERMS)).otherwise(0).alias("net_investment"),
        "dpd",
        F.when(ended, net_investment(*[f"term_{t}" for t in _TERMS], at_termination=True)).otherwise(0).alias("ni_at_termination"),
        "dpd_at_termination",
        F.when(ended, term_gross + term_balance).otherwise(0).alias("payments_made_at_termination"),
        F.when(ended, -term_balance).otherwise(0).alias("balance_remaining_at_termination"),
    )


def accounting(
    cat: TableCatalog,
    as_of: str | datetime,
    previous: DataFrame | None = None,
    *,
    null_safe: bool = False,
    new_rows: bool = False,
    sums: DataFrame | None = None,
) -> DataFrame:
    """The accounting extract; with ``previous`` only contracts whose balances changed, with ``sums`` from maintained sums."""
    out = accounting_snapshot(cat, as_of, sums)
    if previous is not None:
        out = snapshot_diff(out, previous, "contract_oid", TRACKED, null_safe=null_safe, new_rows=new_rows)
        out = out.filter(F.col("change_status") == CHANGED)
    zeroed = {c: default(c, 0) for c in ("residual", "deferred_residual", "deferred_expense", "security_deposit")}
    return out.withColumns(zeroed).select(*OBJECTS["accounting"].columns)


def gross_definition_check(cat: TableCatalog) -> DataFrame:
    """Terminated contracts on which two definitions of the gross receivable disagree."""
    buckets = [
        gross_bucket("gross_receivable", TERMINATION_GROSS_PROCESSES, default=0),
        gross_bucket("gross_receivable_narrow", NARROW_GROSS_PROCESSES, default=0),
    ]
    gross = (F.col("account_id") == GROSS_ACCOUNT) & F.col("process_oid").isin(*TERMINATION_GROSS_PROCESSES)
    gl = cat.read("general_ledger").filter(gross)
    sums = ledger_buckets(gl, cat.read("general_ledger_account_id"), buckets)
    ended = contract_scope(cat.read("contract"), terminated=1).select("contract_oid")
    # A contract without such rows has 0 on both sides and cannot disagree.
    return ended.join(sums, "contract_oid").filter(F.col("gross_receivable") != F.col("gross_receivable_narrow"))


def net_investments(cat: TableCatalog, as_of: str | datetime) -> DataFrame:
    """The earlier, narrower extract: net investment and days past due now and at termination."""
    ended = ("ni_at_termination", "dpd_at_termination", "payments_made_at_termination", "balance_remaining_at_termination")
    return accounting_snapshot(cat, as_of).select("contract_oid", "opportunity", "net_investment", "dpd", *ended)


def stored_totals(stored: DataFrame) -> DataFrame:
    """A stored copy summed up per contract before it is compared: missing measures are 0, rows without contract are 0's."""
    contract = F.coalesce("contract_oid", F.lit(0)).alias("contract_oid")
    measures = ("gross_receivable", "original_gross_receivable", *_TERMS)
    return stored.groupBy(contract).agg(*[F.sum(F.coalesce(m, F.lit(0))).alias(m) for m in measures])


def balances(cat: TableCatalog, as_of: str | datetime) -> DataFrame:
    """The balances-only form: contract balances at ``as_of`` without termination, invoices or payments."""
    contracts = contract_scope(cat.read("contract")).select("contract_oid")
    account_ids = only(cat.read("general_ledger_account_id"), contracts, "contract_oid")
    sums = ledger_snapshot(cat.read("general_ledger"), account_ids, as_of)
    made = (F.col("gross_receivable") - F.col("balance_remaining")).alias("payments_made")
    base = with_opportunity(contracts, cat).join(sums, "contract_oid", "left")
    return base.select("contract_oid", "opportunity", "gross_receivable", "original_gross_receivable", made, *_TERMS)


def balance_series(cat: TableCatalog, dates: list[str | datetime]) -> DataFrame:
    """The balances of booked company contracts for each of ``dates``, from one pass over the ledger."""
    contracts = contract_scope(cat.read("contract")).select("contract_oid")
    account_ids = only(cat.read("general_ledger_account_id"), contracts, "contract_oid")
    return ledger_series(cat.read("general_ledger"), account_ids, dates)
