"""Journal export for the accounting package."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.functions.predicates import contains, exclude, in_codes, in_month, row_predicate
from ledgersync.functions.scalar import (
    JOURNAL_TYPES,
    RECLASS_ACCOUNT,
    RECLASS_BY_REASON,
    classify,
    classify_contract,
    default,
    memo,
    party_name,
    prefix,
    reclass,
    us_date,
)
from ledgersync.operators.aggregates import sign_split
from ledgersync.operators.joins import code_lookup, lookup, star_left
from ledgersync.operators.sets import ordered
from ledgersync.operators.windows import number_lines
from ledgersync.sources.catalog import TableCatalog
from ledgersync.sources.inline import vendor_table

# Fixed values of the export.
EXPORT_COMPANY = 1
TAX_ACCOUNT = "01-10108"
NO_STATE = "E-100"
DEPARTMENT = 10
CURRENCY = "USD"
TAX_VENDOR_ACCOUNT = "20006"
FIXED_VENDOR_ACCOUNT = "20007"
FIXED_VENDOR = "V00296"
BOOKING_PROCESS = 20119
ZEROED_ACCOUNTS = ("01-10094", "01-10002")
DRAFT_ACCOUNTS = ("01-20025", "01-10040")
DRAFT_PROCESSES = (20119, 20121, 20143)
DRAFT_TRANSACTIONS = ("Miscellaneous Billing", "Booking Adjustment")
ADJUSTED_ACCOUNTS = ("11004", "14006")
ADJUSTED_MARKS = ("Adj", "MOD")
TERMINATION_REASONS = ("EOL", "ES", "IC", "UW", "I", "CO")

_GROUP = (
    "journal_number post_date account_id account_title contract_id name contract_type process_oid transaction_type state"
    " title_account reason"
).split()


def termination_reasons(cat: TableCatalog) -> DataFrame:
    """(contract, type, reason) combinations with a recognised reason."""
    codes = cat.read("lti_values").filter(F.col("data_value").isin(*TERMINATION_REASONS))
    rw = code_lookup(cat.read("contract_rewrite"), codes, "reason_code_oid", {"data_value": "reason"}, how="inner")
    return rw.select("contract_oid", "type_oid", "reason_code_oid", "reason").distinct()


def journal_groups(cat: TableCatalog, month: str | date | datetime) -> DataFrame:
    """Ledger of the month per journal, account, contract and reason, with the net split by sign.

    The delivered query groups twice, the second time by the first sums; as the
    first keys are unique, one grouping gives the same rows.
    """
    gl = cat.read("general_ledger").filter(in_month("post_date", month))
    refs = cat.read("general_ledger_reference").filter(F.col("company_oid") == EXPORT_COMPANY)
    gl = lookup(gl, refs, "general_ledger_reference_oid", {"invoice_detail_oid": "invoice_detail_oid"}, "inner")
    # Detail rows that share every joining key are summed first; the descriptive joins then run on fewer rows.
    keys = ["journal_number", "post_date", "account_id", "process_oid", "general_ledger_account_id_oid", "invoice_detail_oid"]
    gl = gl.groupBy(*keys).agg(F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))
    gl = star_left(
        gl,
        [
            (
                cat.read("general_ledger_account_id"),
                "general_ledger_account_id_oid",
                {"contract_oid": "contract_oid", "gl_accounts_oid": "gl_accounts_oid"},
            ),
            (cat.read("gl_accounts"), "gl_accounts_oid", {"account_title": "account_title"}),
            (cat.read("contract"), "contract_oid", {"contract_id": "contract_id", "entity_oid": "entity_oid"}),
            (cat.read("invoice_detail"), "invoice_detail_oid", {"location_oid": "location_oid"}),
            (cat.read("location"), [("location_oid", "oid")], {"state": "location_state"}),
            (termination_reasons(cat), "contract_oid", {"reason": "reason"}),
        ],
    )
    parties = cat.read("entity").select("oid", party_name("bus_or_ind", "name", "fname", "mname", "lname", "suffix").alias("party"))
    # A contract without entity still gets the empty person name.
    gl = lookup(gl, parties, [("entity_oid", "oid")], {"party": "name"}).withColumn("name", default("name", ""))
    gl = code_lookup(gl, cat.read("lti_values"), "process_oid", {"descr": "transaction_type"})
    gl = gl.withColumns(
        {
            "contract_type": classify_contract("contract_id"),
            "state": F.when(F.col("account_id") == TAX_ACCOUNT, F.col("location_state")),
            "title_account": prefix("account_title", 5),
        }
    )
    sums = gl.groupBy(*_GROUP).agg(F.sum("debit").alias("debit_sum"), F.sum("credit").alias("credit_sum"))
    net = default("debit_sum", 0) + default("credit_sum", 0)
    return sign_split(sums.withColumn("net", net), "net")


def journal_export(
    cat: TableCatalog,
    month: str | date | datetime,
    accounts: tuple[str, ...] | None = None,
    simple_state: bool = False,
    description_prefix: str = "Journal ",
) -> DataFrame:
    """Numbered journal lines of a month, in import order.

    ``accounts`` restricts the export accounts (the narrow form uses the two rental
    income ones with ``simple_state``).
    """
    j = journal_groups(cat, month).withColumn("account", reclass("title_account", "net", "debit_sum", "reason"))
    j = j.withColumn("location", default("state", NO_STATE))
    zeroed = (F.col("process_oid") == BOOKING_PROCESS) & F.col("account_id").isin(*ZEROED_ACCOUNTS)
    j = j.withColumns({c: F.when(zeroed, F.lit(0)).otherwise(F.col(c)) for c in ("debit", "credit")})
    j = j.filter((F.col("debit") != 0) | (F.col("credit") != 0))
    adjusted = contains("transaction_type", ADJUSTED_MARKS[0]) | contains("transaction_type", ADJUSTED_MARKS[1])
    j = exclude(j, adjusted & F.col("account").isin(*ADJUSTED_ACCOUNTS))
    if accounts:
        j = j.filter(in_codes("account", accounts))
    j = lookup(j, vendor_table(cat.spark), [("location", "sut_state")], {"vendor_id": "tax_vendor"})
    order = [
        "post_date", "contract_id", "account", "account_id", "account_title", "process_oid", "transaction_type", "name",
        "location", "reason",
    ]
    j = number_lines(j, "journal_number", order)
    draft = row_predicate(F.col("account_id").isin(*DRAFT_ACCOUNTS), "journal_number")
    draft = draft | F.col("process_oid").isin(*DRAFT_PROCESSES) | F.col("contract_id").isNull()
    if not simple_state:
        draft = draft | default(F.col("transaction_type").isin(*DRAFT_TRANSACTIONS), False)
    out = j.select(
        F.lit("").alias("donotimport"),
        classify("process_oid", JOURNAL_TYPES).alias("journal"),
        us_date("post_date").alias("date"),
        F.concat(F.lit(description_prefix), F.col("journal_number").cast("string")).alias("description"),
        "line_no",
        F.col("account").alias("acct_no"),
        F.col("location").alias("location_id"),
        F.lit(DEPARTMENT).alias("dept_id"),
        memo("contract_type", "contract_id", "name", "transaction_type").alias("memo"),
        "transaction_type",
        "debit",
        "credit",
        F.lit(CURRENCY).alias("currency"),
        F.when(draft, "Draft").otherwise("Post").alias("state"),
        F.col("contract_id").alias("project_id"),
        F.when(F.col("account") == FIXED_VENDOR_ACCOUNT, FIXED_VENDOR)
        .when(F.col("account") == TAX_VENDOR_ACCOUNT, F.col("tax_vendor"))
        .alias("vendor_id"),
        "journal_number",
    )
    return ordered(out, "journal_number", "date", "project_id", "acct_no", "line_no")


def rental_income_check(cat: TableCatalog, month: str | date | datetime) -> DataFrame:
    """Journal rows on the rental income account without any debit."""
    j = journal_groups(cat, month).filter((F.col("title_account") == RECLASS_ACCOUNT) & F.col("debit_sum").isNull())
    return j.select(
        "journal_number", "post_date", "account_id", "account_title", "debit", "credit", "contract_id", "name", "contract_type",
        "process_oid", "transaction_type", default("state", NO_STATE).alias("location"),
        reclass("title_account", "net", "debit_sum", "reason").alias("account"),
        classify("process_oid", JOURNAL_TYPES).alias("journal"), "reason",
    )


NARROW_ACCOUNTS = (RECLASS_ACCOUNT, RECLASS_BY_REASON)
