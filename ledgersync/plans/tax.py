"""Tax details and tax codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.functions.predicates import contains, in_codes, require
from ledgersync.operators.joins import code_lookup, lookup
from ledgersync.operators.sets import ordered
from ledgersync.sources.catalog import TableCatalog

# Fixed value: item types of the applied-tax report.
TAXED_ITEM_TYPES = (1, 9)


def tax_detail(cat: TableCatalog) -> DataFrame:
    """Finalised tax rows with product, exceptions still active, code, state and rates."""
    td = cat.read("tax_detail_finalized").filter(F.col("contract_oid") != 0)
    td = code_lookup(td, cat.read("lti_values"), "tax_jurisdiction_oid", {"descr": "tax_jurisdiction"})
    td = lookup(td, cat.read("tax_product"), "tax_product_oid", {"description": "product"})
    # Exceptions are put together by item first: most tax rows have none, and their empty ids would all meet in one task.
    exceptions = lookup(cat.read("tax_exception_asset"), cat.read("tax_exception"), "tax_exception_oid", {"inactive_date": "inactive_date"})
    of_exception = {
        "tax_code_oid": "exception_tax_code_oid",
        "jurisdiction_oid": "exception_jurisdiction_oid",
        "taxability_oid": "exception_taxability_oid",
        "rate_override": "rate_override",
        "rate_adjustment": "rate_adjustment",
    }
    exceptions = lookup(exceptions, cat.read("tax_exception_detail"), "tax_exception_oid", of_exception)
    found = {c: c for c in ("tax_exception_oid", "inactive_date", *of_exception.values())}
    td = lookup(td, exceptions, "contract_item_oid", found).filter(F.col("inactive_date").isNull())
    td = lookup(td, cat.read("tax_code"), "tax_code_oid", {"code": "code", "description": "code_description", "state_oid": "state_oid"})
    td = lookup(td, cat.read("state"), [("state_oid", "oid")], {"name": "state_name"})
    rates = {
        "tax_type": "tax_type",
        "description": "rate_description",
        "tax_rate": "code_rate",
        "min_taxable_amount": "min_taxable_amount",
        "max_taxable_amount": "max_taxable_amount",
    }
    td = lookup(td, cat.read("tax_rate"), "tax_code_oid", rates).drop("state_oid", "inactive_date", "tax_jurisdiction_oid")
    return ordered(td, "contract_oid", "contract_item_oid", "payment_date")


def tax_code_values(cat: TableCatalog, text: str = "Tax") -> DataFrame:
    """Code-table rows of the tax domains."""
    return cat.read("lti_values").filter(contains("table_key", text)).select("table_key", "oid", "data_value")


def tax_codes(cat: TableCatalog) -> DataFrame:
    """Tax codes with jurisdiction, administration and their rates."""
    codes = cat.read("lti_values")
    tc = code_lookup(cat.read("tax_code"), codes, "jurisdiction_oid", {"data_value": "jurisdiction"})
    tc = code_lookup(tc, codes, "administration_oid", {"data_value": "administration"})
    rates = {
        "tax_type": "tax_type",
        "description": "rate_description",
        "tax_rate": "tax_rate",
        "min_taxable_amount": "min_taxable_amount",
        "max_taxable_amount": "max_taxable_amount",
    }
    tc = lookup(tc, cat.read("tax_rate"), "tax_code_oid", rates)
    return tc.select("code", "jurisdiction", "administration", "description", *rates.values()).distinct()


def applied_tax(cat: TableCatalog, contract_oid: int | None = None) -> DataFrame:
    """Tax rows of the taxed item types with product and taxability texts, for all contracts or one."""
    td = require(cat.read("tax_detail_finalized"), "contract_oid")
    td = td.filter((F.col("contract_oid") >= 2) & in_codes("contract_item_type_oid", TAXED_ITEM_TYPES))
    if contract_oid is not None:
        td = td.filter(F.col("contract_oid") == contract_oid)
    codes = cat.read("lti_values")
    td = lookup(td, cat.read("tax_product"), "tax_product_oid", {"description": "product"})
    td = code_lookup(td, codes, "applied_taxability_oid", {"data_value": "applied_taxability"})
    td = code_lookup(td, codes, "applied_tax_payment_type_oid", {"data_value": "applied_tax_payment_type"})
    td = td.drop("tax_jurisdiction_oid", "applied_taxability_oid", "applied_tax_payment_type_oid")
    return ordered(td, "contract_oid", "contract_item_oid")


def combined_tax(cat: TableCatalog, contract_oid: int | None = None) -> DataFrame:
    """Taxability per invoice: applied tax with its codes (by code text) and the invoice header."""
    td = applied_tax(cat, contract_oid).withColumn("code_text", F.col("tax_code_oid").cast("string"))
    td = lookup(td, tax_codes(cat), [("code_text", "code")], {"code": "matched_code"})
    td = lookup(
        td, cat.read("invoice_detail"), [("parent_invoice_detail_oid", "invoice_detail_oid")], {"invoice_header_oid": "invoice_header_oid"}
    )
    return td.select("contract_oid", "invoice_header_oid", "parent_invoice_detail_oid", "applied_taxability")
