"""Delinquency status per contract."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.functions.clock import ts
from ledgersync.functions.predicates import contract_scope
from ledgersync.functions.scalar import days_between_rounded
from ledgersync.operators.aggregates import count_flag, due_buckets
from ledgersync.operators.joins import extreme_rows, lookup
from ledgersync.operators.sync import snapshot_diff
from ledgersync.plans.common import with_opportunity
from ledgersync.sources.catalog import TableCatalog


def next_payment(cat: TableCatalog) -> DataFrame:
    """Amount, tax and total of the earliest un-invoiced start date per contract."""
    streams = cat.read("payment_stream").filter(F.col("contract_term_oid").isNotNull() & (F.col("is_invoiced") == 0))
    items = cat.read("payment_stream_contract_item").groupBy("payment_stream_oid").agg(
        F.sum("amount").alias("amount"), F.sum("on_stream_tax_amount").alias("tax")
    )
    per_start = (
        streams.join(items, "payment_stream_oid")
        .groupBy("contract_oid", "start_date")
        .agg(F.sum("amount").alias("amount"), F.sum("tax").alias("tax"))
    )
    first = per_start.groupBy("contract_oid").agg(F.min_by(F.struct("amount", "tax"), "start_date").alias("p"))
    return first.select(
        "contract_oid",
        F.col("p.amount").alias("amount"),
        F.col("p.tax").alias("tax"),
        (F.col("p.amount") + F.col("p.tax")).alias("total"),
    )


def delinquency(
    cat: TableCatalog,
    as_of: str | datetime,
    previous: DataFrame | None = None,
    *,
    oldest: str = "max",
    returned_only: bool = False,
) -> DataFrame:
    """Receivable status, last payment and next payment of booked company contracts.

    ``previous`` (contract key and returned-payment count) adds the change label.
    """
    now = ts(as_of)
    payments = cat.read("payment")
    good = payments.filter((F.col("is_posted") == 1) & (F.col("is_returned") == 0))
    last = extreme_rows(good.select("contract_oid", "reference_number", "effective_date"), ["contract_oid"], "effective_date")
    returned = count_flag(payments, ["contract_oid"], "is_returned", "payments_returned", only_set=returned_only)
    due = due_buckets(cat.read("invoice_detail"), cat.read("invoice_header"), cat.read("transaction_code"), as_of, oldest)
    late = F.when(F.col("latest_rent_due") >= now, 0).otherwise(days_between_rounded(now, "latest_rent_due"))
    due = due.withColumn("days_delinquent", F.when(F.col("latest_rent_due").isNotNull(), late))
    c = contract_scope(cat.read("contract")).select("contract_oid", "contract_id")
    c = with_opportunity(c, cat, how="left")
    money = ("current_due", "past_due", "misc_due", "total_due", "oldest_rent_due", "days_delinquent")
    c = lookup(c, due, "contract_oid", {m: m for m in money})
    c = lookup(c, last, "contract_oid", {"effective_date": "effective_date", "reference_number": "reference_number"})
    c = lookup(c, returned, "contract_oid", {"payments_returned": "payments_returned"})
    c = lookup(c, next_payment(cat), "contract_oid", {"amount": "payment_amount", "tax": "payment_tax", "total": "payment_total"})
    return c if previous is None else snapshot_diff(c, previous, "contract_oid", ["payments_returned"])
