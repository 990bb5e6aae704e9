"""Invoice lines, invoice headers and their settlement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.functions.clock import Window
from ledgersync.functions.predicates import changed_between, contract_scope, require
from ledgersync.operators.aggregates import invoice_settlement
from ledgersync.operators.joins import code_lookup, lookup, require_match
from ledgersync.operators.sets import ordered
from ledgersync.plans.common import with_opportunity
from ledgersync.registry import OBJECTS
from ledgersync.sources.catalog import TableCatalog

# Transaction texts of the settlement report.
SETTLED_TRANSACTIONS = ("Lease Payment", "EFA Payment")


def invoice_lines(cat: TableCatalog, window: Window | None = None, active_only: bool = True) -> DataFrame:
    """Posted invoice lines of booked contracts."""
    d = changed_between(cat.read("invoice_detail"), "last_change_datetime", window)
    d = require_match(d, contract_scope(cat.read("contract"), terminated=0 if active_only else None), "contract_oid")
    posted = cat.read("invoice_header").filter(F.col("is_posted") == 1)
    d = lookup(d.drop("due_date"), posted, "invoice_header_oid", {"invoice_date": "invoice_date", "due_date": "due_date"}, "inner")
    d = lookup(d, cat.read("transaction_code"), "transaction_code_oid", {"description": "description"})
    d = code_lookup(d, cat.read("lti_values"), "open_closed_oid", {"data_value": "invoice_payment_method"})
    d = d.withColumns(
        {
            "name": F.col("invoice_detail_oid"),
            "payment_method_oid": F.col("open_closed_oid"),
            "transaction_code": F.col("transaction_code_oid"),
        }
    )
    return with_opportunity(d, cat).select(*OBJECTS["invoice"].columns)


def invoice_headers(cat: TableCatalog, window: Window | None = None) -> DataFrame:
    """Invoice header keys; the opportunity may be missing."""
    h = changed_between(require(cat.read("invoice_header"), "invoice_header_oid"), "last_change_datetime", window)
    h = require_match(h, cat.read("contract"), "contract_oid")
    return with_opportunity(h, cat, how="left").select(*OBJECTS["invoice_header"].columns).distinct()


def _rent_invoices(cat: TableCatalog) -> DataFrame:
    codes = cat.read("transaction_code").filter(F.col("description").isin(*SETTLED_TRANSACTIONS))
    inv = require(cat.read("invoice_detail"), "contract_oid")
    inv = lookup(inv, codes, "transaction_code_oid", {"description": "description"}, "inner")
    inv = code_lookup(inv, cat.read("lti_values"), "open_closed_oid", {"data_value": "invoice_payment_method"})
    return inv.select(
        "contract_oid", "invoice_detail_oid", "is_paid", F.to_date("due_date").alias("invoice_due_date"), "description",
        "invoice_payment_method", "original_due_amount", "current_due_amount",
    )


def applied_payments(cat: TableCatalog) -> DataFrame:
    """Applied amounts of payments per existing invoice line."""
    p = cat.read("payment").select("payment_oid", "is_returned", "post_date")
    d = cat.read("cash_receipt_detail").select("cash_receipt_billable_oid", "invoice_detail_oid", "applied_amount")
    d = lookup(d, cat.read("cash_receipt_billable"), "cash_receipt_billable_oid", {"cash_receipt_header_oid": "header"}, "inner")
    d = lookup(d, cat.read("cash_receipt_header"), [("header", "cash_receipt_header_oid")], {"payment_oid": "payment_oid"}, "inner")
    d = require_match(d, cat.read("invoice_detail"), "invoice_detail_oid")
    return d.join(p, "payment_oid").select("invoice_detail_oid", "applied_amount", "is_returned", "post_date")


def settlement_lines(cat: TableCatalog) -> DataFrame:
    """Every contract with its rent invoices and each payment applied to them."""
    paid = applied_payments(cat).filter(F.col("is_returned") == 0).withColumn("pay_in_full_date", F.to_date("post_date"))
    inv = lookup(
        _rent_invoices(cat), paid, "invoice_detail_oid", {"pay_in_full_date": "pay_in_full_date", "applied_amount": "total_applied_amount"}
    )
    return _per_contract(cat, inv)


def settlement(cat: TableCatalog) -> DataFrame:
    """As ``settlement_lines``, payments rolled up to one row per invoice line."""
    return _per_contract(cat, invoice_settlement(_rent_invoices(cat), applied_payments(cat)))


def _per_contract(cat: TableCatalog, inv: DataFrame) -> DataFrame:
    out = cat.read("contract").select("contract_oid").join(inv, "contract_oid", "left").select(
        "contract_oid", "invoice_detail_oid", "is_paid", "invoice_due_date", "pay_in_full_date", "description",
        "invoice_payment_method", "original_due_amount", "current_due_amount", "total_applied_amount",
    )
    return ordered(out, "contract_oid", "invoice_detail_oid")
