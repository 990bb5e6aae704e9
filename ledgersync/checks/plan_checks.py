"""The extracts, each against an independent SQL statement of its meaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.checks.harness import (
    AS_OF,
    END,
    JOURNAL_MONTH,
    MIDDLE,
    NOTE_END,
    NOTE_MIDDLE,
    NOTE_START,
    PREV_AS_OF,
    START,
    Registry,
    merge_sql,
)
from ledgersync.functions.clock import Window, ts
from ledgersync.operators.sync import merge_object
from ledgersync.plans import accounting as acc
from ledgersync.plans import amortization as am
from ledgersync.plans import banking, contracts, delinquency, equipment, invoices, journal, notes, payments, schedules, tax
from ledgersync.operators.sets import union_arms
from ledgersync.registry import OBJECTS, PUBLISHED
from ledgersync.session import scratch_path, stored
from ledgersync.sources.sink import publish_all
from ledgersync.sources.star import StarCatalog

plans = Registry()
WINDOW = Window.of(START, END)
NOTE_WINDOW = Window.of(NOTE_START, NOTE_END)

OPP = "(SELECT DISTINCT ref_oid, COALESCE(field_value, 'NULL') AS opportunity FROM lease_generic_value WHERE genf_oid = 23)"
SCOPE = "is_booked = 1 AND company_oid = 1"


def _win(*cols: str, start: str = START, end: str = END) -> str:
    return " OR ".join(f"COALESCE({c} BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}', FALSE)" for c in cols)


def _register(
    name: str,
    obj: str,
    schema: str,
    build: Callable[[StarCatalog, Window | None], DataFrame],
    body: str,
    *,
    stale: str = "opportunity",
    window: Window = WINDOW,
    middle: str = MIDDLE,
    initial: bool = True,
) -> None:
    """Register the full extract and its incremental merge into an older, partly stale target.

    ``body`` yields the object's columns plus ``in_window``.
    """
    spec = OBJECTS[obj]

    def target(cat: StarCatalog) -> DataFrame:
        old = build(cat, None).filter(F.col(spec.changed) < ts(middle))
        return old.withColumn(stale, F.lit("STALE"))

    def merged(cat: StarCatalog) -> DataFrame:
        return merge_object(target(cat), build(cat, window), spec)

    names = ", ".join(spec.columns)
    if initial:
        plans.add(name, schema, lambda cat: build(cat, None), f"SELECT {names} FROM ({body}) AS b")
    t_cols = ", ".join(f"'STALE' AS {c}" if c == stale else c for c in spec.columns)
    t = f"SELECT {t_cols} FROM ({body}) AS b WHERE {spec.changed} < TIMESTAMP '{middle}'"
    s = f"SELECT {names} FROM ({body}) AS b WHERE in_window"
    plans.add(f"{name}_merged", schema, merged, merge_sql(t, s, spec))


# --- accounting ---------------------------------------------------------------------------

_ACC_SCHEMA = (
    "contract_oid bigint, opportunity string, gross_receivable double, original_gross_receivable double, payments_made double,"
    " balance_remaining double, unearned_finance double, residual double, deferred_residual double, deferred_expense double,"
    " security_deposit double, net_investment double, dpd bigint, ni_at_termination double, dpd_at_termination bigint,"
    " payments_made_at_termination double, balance_remaining_at_termination double"
)


def _oldest_sql(as_of: str, due_not: str, terminated: int) -> str:
    codes = "transaction_code_oid IN (1, 35, 25, 37, 43)"
    return f"""
      SELECT d.contract_oid, MIN(d.due_date) AS oldest FROM (
          SELECT contract_oid, invoice_header_oid, due_date, SUM(original_due_amount) AS due FROM lease_invoice_detail
          WHERE due_date <= TIMESTAMP '{as_of}' AND {codes} AND open_closed_oid NOT IN ({due_not})
          GROUP BY contract_oid, invoice_header_oid, due_date) AS d
        JOIN lease_contract AS k ON k.contract_oid = d.contract_oid AND k.is_terminated = {terminated}
        LEFT JOIN (
          SELECT i.contract_oid, i.invoice_header_oid, SUM(h.applied_amount) AS paid
          FROM lease_invoice_payment_history AS h JOIN lease_invoice_detail AS i ON i.invoice_detail_oid = h.invoice_detail_oid
          WHERE h.applied_date <= TIMESTAMP '{as_of}' AND i.due_date <= TIMESTAMP '{as_of}' AND i.{codes}
            AND i.open_closed_oid NOT IN (11022, 11023)
          GROUP BY i.contract_oid, i.invoice_header_oid) AS p
        ON p.contract_oid = d.contract_oid AND p.invoice_header_oid = d.invoice_header_oid
      WHERE d.due - COALESCE(p.paid, 0) > 0 GROUP BY d.contract_oid"""


def _account_sums(cond: str) -> str:
    return f"""
      SUM(amt) FILTER (WHERE {cond} AND account_id IN ('01-10089', '01-10090')) AS bal,
      -SUM(amt) FILTER (WHERE {cond} AND account_id = '01-10092') AS unearned,
      SUM(amt) FILTER (WHERE {cond} AND account_id = '01-10091') AS resid,
      -SUM(amt) FILTER (WHERE {cond} AND account_id = '01-10093') AS def_resid,
      SUM(amt) FILTER (WHERE {cond} AND account_id = '01-10094') AS def_exp,
      -SUM(amt) FILTER (WHERE {cond} AND account_id = '01-10130') AS deposit"""


def accounting_sql(as_of: str) -> str:
    """The accounting extract before any change filter, NULL measures kept."""
    posted = f"post_date <= TIMESTAMP '{as_of}'"
    gl = """(SELECT a.contract_oid, g.account_id, g.process_oid, g.post_date, COALESCE(g.debit, 0) + COALESCE(g.credit, 0) AS amt
             FROM lease_general_ledger AS g
             JOIN lease_general_ledger_account_id AS a ON a.general_ledger_account_id_oid = g.general_ledger_account_id_oid)"""
    return f"""
      WITH cur AS (
        SELECT contract_oid,
          SUM(amt) FILTER (WHERE account_id = '01-10089' AND process_oid IN (20119, 20126, 20127, 20140, 20141, 20143)) AS gross,
          COALESCE(SUM(amt) FILTER (WHERE account_id = '01-10089' AND process_oid IN (20119, 20126, 20127, 20140)), 0) AS orig,
          {_account_sums('TRUE')}
        FROM {gl} AS l WHERE {posted} GROUP BY contract_oid),
      fin AS (SELECT contract_oid, {_account_sums('TRUE')} FROM {gl} AS l WHERE process_oid = 20143 GROUP BY contract_oid),
      fin_gross AS (
        SELECT contract_oid, SUM(amt) AS gross FROM {gl} AS l
        WHERE account_id = '01-10089' AND process_oid IN (20119, 20126, 20127, 20140, 20141) GROUP BY contract_oid),
      late AS ({_oldest_sql(as_of, '11022, 11023', 0)}),
      late_term AS ({_oldest_sql(as_of, '11020, 11021, 11024, 11025', 1)})
      SELECT c.contract_oid, o.opportunity, cur.gross AS gross_receivable, cur.orig AS original_gross_receivable,
        cur.gross - cur.bal AS payments_made, cur.bal AS balance_remaining, cur.unearned AS unearned_finance, cur.resid AS residual,
        cur.def_resid AS deferred_residual, cur.def_exp AS deferred_expense, cur.deposit AS security_deposit,
        CASE WHEN c.is_terminated = 0 THEN COALESCE(cur.bal - COALESCE(cur.unearned, 0) + COALESCE(cur.resid, 0)
          - COALESCE(cur.def_resid, 0) + COALESCE(cur.def_exp, 0) - COALESCE(cur.deposit, 0), 0) ELSE 0 END AS net_investment,
        GREATEST(COALESCE(DATE_DIFF('day', late.oldest, TIMESTAMP '{as_of}'), 0), 0) AS dpd,
        CASE WHEN c.is_terminated = 1 THEN -(COALESCE(fin.bal, 0) - COALESCE(fin.unearned, 0) + COALESCE(fin.resid, 0)
          - COALESCE(fin.def_resid, 0) + COALESCE(fin.def_exp, 0) - COALESCE(fin.deposit, 0)) ELSE 0 END AS ni_at_termination,
        GREATEST(COALESCE(DATE_DIFF('day', late_term.oldest, c.termination_date), 0), 0) AS dpd_at_termination,
        CASE WHEN c.is_terminated = 1 THEN COALESCE(fin_gross.gross, 0) + COALESCE(fin.bal, 0) ELSE 0 END AS payments_made_at_termination,
        CASE WHEN c.is_terminated = 1 THEN -COALESCE(fin.bal, 0) ELSE 0 END AS balance_remaining_at_termination
      FROM lease_contract AS c JOIN {OPP} AS o ON o.ref_oid = c.contract_oid
      LEFT JOIN cur ON cur.contract_oid = c.contract_oid LEFT JOIN fin ON fin.contract_oid = c.contract_oid
      LEFT JOIN fin_gross ON fin_gross.contract_oid = c.contract_oid LEFT JOIN late ON late.contract_oid = c.contract_oid
      LEFT JOIN late_term ON late_term.contract_oid = c.contract_oid
      WHERE c.{SCOPE.replace('company', 'c.company')}"""


_ZEROED = ("residual", "deferred_residual", "deferred_expense", "security_deposit")
_DELIVERED = "SELECT * REPLACE (" + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _ZEROED) + ")"
_STORED = f"{_DELIVERED} FROM ({accounting_sql(PREV_AS_OF)}) AS q WHERE gross_receivable IS NOT NULL"
_DIFFERS = " OR ".join(
    f"n.{c} <> p.{c}"
    for c in (
        "gross_receivable original_gross_receivable payments_made balance_remaining unearned_finance residual deferred_residual"
        " deferred_expense security_deposit"
    ).split()
)
_CHANGES = f"""{_DELIVERED} FROM (SELECT n.* FROM ({accounting_sql(AS_OF)}) AS n JOIN ({_STORED}) AS p
  ON p.contract_oid = n.contract_oid WHERE {_DIFFERS}) AS q"""


def _stored(cat: StarCatalog) -> DataFrame:
    return acc.accounting(cat, PREV_AS_OF).filter(F.col("gross_receivable").isNotNull())


plans.add("p01_accounting_snapshot", _ACC_SCHEMA, lambda c: acc.accounting(c, AS_OF), f"{_DELIVERED} FROM ({accounting_sql(AS_OF)}) AS q")
plans.add("p01_accounting_changes", _ACC_SCHEMA, lambda c: acc.accounting(c, AS_OF, _stored(c)), _CHANGES)
def _merged_accounting(cat: StarCatalog) -> DataFrame:
    """The stored snapshot is a table, as it is downstream: compared with and merged into. So are the account ids, read for both dates."""
    ids = "general_ledger_account_id"
    cat = StarCatalog(cat.spark, cat.root, overrides={**cat.overrides, ids: stored(cat.read(ids), "account-ids")})
    held = stored(_stored(cat), "stored-accounting")
    return merge_object(held, acc.accounting(cat, AS_OF, held), OBJECTS["accounting"])


plans.add(
    "p01_accounting_merged",
    _ACC_SCHEMA,
    _merged_accounting,
    merge_sql(_STORED, _CHANGES, OBJECTS["accounting"]),
)

# --- contracts, collectors, customers, phones ----------------------------------------------

_register(
    "p02_collector",
    "collector",
    "contract_oid bigint, opportunity string, collector_name string, permanent_collection_assignment_flag int,"
    " last_change_datetime ts, last_change_operator string",
    contracts.collectors,
    f"""SELECT c.contract_oid, o.opportunity, k.name AS collector_name, e.permanent_collection_assignment_flag,
          e.last_change_datetime, e.last_change_operator, {_win('e.last_change_datetime')} AS in_window
        FROM lease_contract AS c LEFT JOIN lease_entity AS e ON e.oid = c.entity_oid LEFT JOIN lease_entity AS k ON k.oid = e.collector_oid
        JOIN {OPP} AS o ON o.ref_oid = c.contract_oid""",
)

_register(
    "p03_contract",
    "contract",
    "contract_oid bigint, opportunity string, transaction_code string, invoice_code string, is_suspend_invoice int,"
    " implicit_rate double, internal_yield_rate double, invoice_lead_days string, tax_treatment string, cash_application string,"
    " is_non_accrual int, non_accrual_effective_date ts, is_terminated int, termination_date ts, last_change_operator string,"
    " last_change_datetime ts",
    contracts.contracts,
    f"""SELECT c.contract_oid, o.opportunity, t.description AS transaction_code, i.description AS invoice_code, c.is_suspend_invoice,
          c.implicit_rate, m.internal_yield_rate, l.description AS invoice_lead_days, x.descr AS tax_treatment,
          a.description AS cash_application, c.is_non_accrual, c.non_accrual_effective_date, c.is_terminated, c.termination_date,
          c.last_change_operator, c.last_change_datetime, {_win('c.last_change_datetime')} AS in_window
        FROM lease_contract AS c JOIN {OPP} AS o ON o.ref_oid = c.contract_oid
        LEFT JOIN lease_transaction_code AS t USING (transaction_code_oid) LEFT JOIN lease_invoice_code AS i USING (invoice_code_oid)
        LEFT JOIN lease_contract_term AS m ON m.contract_oid = c.contract_oid
        LEFT JOIN lease_invoice_lead_days AS l USING (invoice_lead_days_oid)
        LEFT JOIN lease_cash_application_code AS a USING (cash_application_code_oid)
        LEFT JOIN lease_lti_values AS x ON x.table_key = 'TAX_TREATMENT' AND x.data_value = c.tax_treatment""",
)

_ADDR = "COALESCE({0}.addr_line1, '') || COALESCE({0}.addr_line2, '') || ', ' || COALESCE({0}.city, '') || ', ' || COALESCE({0}.state, '') || ' ' || COALESCE({0}.postal_code, '')"
_PICK = """CASE WHEN e.last_change_datetime >= c.last_change_datetime AND e.last_change_datetime >= q.last_change_datetime THEN e.{0}
  WHEN c.last_change_datetime >= e.last_change_datetime AND c.last_change_datetime >= q.last_change_datetime THEN c.{0} ELSE q.{0} END"""

_register(
    "p11_customer",
    "customer",
    "unique_id string, opportunity string, entity_oid bigint, role_type string, name string, legal_name string, alt_name string,"
    " email_address string, bill_to_location string, tax_location string, equipment_bill_to_location string, collector_oid bigint,"
    " collector_name string, permanent_collection_assignment_flag int, last_change_datetime ts, last_change_operator string",
    lambda cat, w: contracts.customers(cat, w, key_sep="-"),
    f"""SELECT c.contract_oid || '-' || h.entt_oid || '-' || LEFT(r.descr, 1) AS unique_id, o.opportunity, h.entt_oid AS entity_oid,
          r.descr AS role_type, e.name, e.legal_name, e.alt_name, e.email_addr AS email_address, {_ADDR.format('b')} AS bill_to_location,
          {_ADDR.format('x')} AS tax_location, q.address AS equipment_bill_to_location,
          CASE WHEN r.descr <> 'Guarantor' THEN e.collector_oid END AS collector_oid,
          CASE WHEN r.descr <> 'Guarantor' THEN k.name END AS collector_name,
          CASE WHEN r.descr <> 'Guarantor' THEN e.permanent_collection_assignment_flag END AS permanent_collection_assignment_flag,
          {_PICK.format('last_change_datetime')} AS last_change_datetime, {_PICK.format('last_change_operator')} AS last_change_operator,
          {_win('e.last_change_datetime', 'c.last_change_datetime', 'q.last_change_datetime')} AS in_window
        FROM lease_contract AS c JOIN lease_child_entity AS h ON h.ref_oid = c.contract_oid AND h.entt_oid <> 1
        JOIN lease_role AS r ON r.oid = h.role_oid AND r.descr NOT IN ('Collector', 'Broker', 'Contract Manager')
        LEFT JOIN lease_entity AS e ON e.oid = h.entt_oid LEFT JOIN lease_entity AS k ON k.oid = e.collector_oid
        LEFT JOIN lease_location AS b ON b.oid = c.bill_to_location_oid LEFT JOIN lease_location AS x ON x.oid = c.tax_location_oid
        LEFT JOIN (SELECT DISTINCT ce.contract_oid, {_ADDR.format('y')} AS address, ce.bill_to_location_oid, ce.last_change_datetime,
            ce.last_change_operator
          FROM lease_contract_equipment AS ce LEFT JOIN lease_location AS y ON y.oid = ce.bill_to_location_oid
          WHERE ce.is_primary_for_pricing = 1) AS q ON q.contract_oid = c.contract_oid
        LEFT JOIN {OPP} AS o ON o.ref_oid = c.contract_oid""",
)

_register(
    "p12_phone",
    "phone",
    "phone_oid bigint, entity_oid bigint, phone_type string, phone_number string, extension string, primary_phone int,"
    " last_change_operator string, last_change_datetime ts",
    contracts.phones,
    f"""SELECT DISTINCT p.oid AS phone_oid, e.oid AS entity_oid, p.phone_type, p.phone_num AS phone_number, p.extension,
          p.is_primary AS primary_phone, p.last_change_operator, p.last_change_datetime, {_win('p.last_change_datetime')} AS in_window
        FROM lease_entity AS e JOIN lease_phone AS p ON p.entt_oid = e.oid""",
    stale="phone_number",
)

# --- banking ------------------------------------------------------------------------------

_MASK = """CASE WHEN LENGTH({0}) = 0 THEN NULL WHEN LENGTH({0}) < 4 THEN REPEAT('x', LENGTH({0}))
  ELSE REPEAT('x', LENGTH({0}) - 4) || RIGHT({0}, 4) END"""

_register(
    "p04_alternate_schedule",
    "eft_alt_schedule",
    "opportunity string, eft_schedule_oid bigint, start_date ts, frequency string, amount double, total_payments bigint,"
    " payments_processed bigint, account_number string, bank_name string, originating_bank string, last_change_datetime ts,"
    " last_change_operator string",
    banking.alternate_schedules,
    f"""SELECT o.opportunity, s.eft_schedule_oid, s.start_date, s.frequency, s.amount, s.total_payments, s.payments_processed,
          {_MASK.format('a.account_number')} AS account_number, b.bank_name, f.description AS originating_bank, s.last_change_datetime,
          s.last_change_operator, {_win('s.last_change_datetime')} AS in_window
        FROM lease_contract AS c JOIN lease_eft_schedule AS s ON s.contract_oid = c.contract_oid
        JOIN lease_ach_bank_account AS a ON a.ach_bank_account_oid = s.receiving_bank_account_oid
        JOIN lease_ach_bank AS b ON b.ach_bank_oid = a.ach_bank_oid
        JOIN lease_eft_bank AS f ON f.eft_bank_oid = s.originating_bank_oid AND f.description NOT LIKE '%ATA%'
        JOIN {OPP} AS o ON o.ref_oid = c.contract_oid
        WHERE c.is_terminated = 0 AND c.is_booked = 1 AND c.company_oid = 1""",
)

_register(
    "p05_auto_debit_assignment",
    "eft_assignment",
    "opportunity string, contract_eft_oid bigint, account_number string, bank_name string, start_date ts, end_date ts,"
    " resume_date ts, last_change_datetime ts, last_change_operator string",
    banking.assignments,
    f"""SELECT o.opportunity, x.contract_eft_oid, {_MASK.format('a.account_number')} AS account_number, b.bank_name, x.start_date,
          x.end_date, x.resume_date, x.last_change_datetime, x.last_change_operator, {_win('x.last_change_datetime')} AS in_window
        FROM lease_contract AS c JOIN lease_contract_eft AS x ON x.contract_oid = c.contract_oid
        JOIN lease_ach_bank_account AS a ON a.ach_bank_account_oid = x.ach_bank_account_oid AND a.account_number IS NOT NULL
        LEFT JOIN lease_ach_bank AS b ON b.ach_bank_oid = a.ach_bank_oid JOIN {OPP} AS o ON o.ref_oid = c.contract_oid
        WHERE c.is_terminated = 0 AND c.is_booked = 1 AND c.company_oid = 1""",
)

plans.add(
    "p17_bank_accounts",
    "ach_bank_oid bigint, ach_bank_account_oid bigint, entity_oid bigint, name string, role_type string, contract_oid bigint,"
    " opportunity string, bank_name string, routing string, account_number string, account_category string, account_type string,"
    " active int, last_change_operator string, last_change_datetime ts",
    banking.bank_accounts,
    f"""SELECT DISTINCT b.ach_bank_oid, a.ach_bank_account_oid, b.entity_oid, e.name, h.role_type, c.contract_oid, o.opportunity,
          b.bank_name, b.dfi_identification_number AS routing, {_MASK.format('a.account_number')} AS account_number,
          v1.descr AS account_category, v2.descr AS account_type, a.active, a.last_change_operator, a.last_change_datetime
        FROM lease_ach_bank AS b JOIN lease_ach_bank_account AS a ON a.ach_bank_oid = b.ach_bank_oid
        LEFT JOIN lease_lti_values AS v1 ON v1.oid = a.account_category_oid LEFT JOIN lease_lti_values AS v2 ON v2.oid = a.account_type_oid
        JOIN lease_child_entity AS h ON h.entt_oid = b.entity_oid AND h.role_type = 'cust' JOIN lease_entity AS e ON e.oid = h.entt_oid
        JOIN lease_contract AS c ON c.contract_oid = h.ref_oid AND c.is_booked = 1 AND c.company_oid = 1
        JOIN {OPP} AS o ON o.ref_oid = c.contract_oid""",
)

# --- invoices -----------------------------------------------------------------------------

_register(
    "p06_invoice_lines",
    "invoice",
    "opportunity string, invoice_header_oid bigint, invoice_detail_oid bigint, name bigint, contract_item_oid bigint,"
    " payment_method_oid bigint, invoice_payment_method string, transaction_code bigint, description string,"
    " original_due_amount double, current_due_amount double, invoice_date ts, due_date ts, is_paid int, last_change_operator string,"
    " last_change_datetime ts",
    invoices.invoice_lines,
    f"""SELECT o.opportunity, d.invoice_header_oid, d.invoice_detail_oid, d.invoice_detail_oid AS name, d.contract_item_oid,
          d.open_closed_oid AS payment_method_oid, v.data_value AS invoice_payment_method, d.transaction_code_oid AS transaction_code,
          t.description, d.original_due_amount, d.current_due_amount, h.invoice_date, h.due_date, d.is_paid, d.last_change_operator,
          d.last_change_datetime, {_win('d.last_change_datetime')} AS in_window
        FROM lease_contract AS c JOIN lease_invoice_detail AS d ON d.contract_oid = c.contract_oid
        LEFT JOIN lease_transaction_code AS t ON t.transaction_code_oid = d.transaction_code_oid
        LEFT JOIN lease_lti_values AS v ON v.oid = d.open_closed_oid
        JOIN lease_invoice_header AS h ON h.invoice_header_oid = d.invoice_header_oid AND h.is_posted = 1
        JOIN {OPP} AS o ON o.ref_oid = c.contract_oid
        WHERE c.is_terminated = 0 AND c.is_booked = 1 AND c.company_oid = 1""",
)

_register(
    "p14_invoice_header",
    "invoice_header",
    "opportunity string, invoice_header_oid bigint, last_change_operator string, last_change_datetime ts",
    invoices.invoice_headers,
    f"""SELECT DISTINCT o.opportunity, h.invoice_header_oid, h.last_change_operator, h.last_change_datetime,
          {_win('h.last_change_datetime')} AS in_window
        FROM lease_contract AS c JOIN lease_invoice_header AS h ON h.contract_oid = c.contract_oid
        LEFT JOIN {OPP} AS o ON o.ref_oid = c.contract_oid""",
)

_SETTLE_SCHEMA = (
    "contract_oid bigint, invoice_detail_oid bigint, is_paid int, invoice_due_date date, pay_in_full_date date, description string,"
    " invoice_payment_method string, original_due_amount double, current_due_amount double, total_applied_amount double"
)
_RENT = """(SELECT d.contract_oid, d.invoice_detail_oid, d.is_paid, d.due_date, t.description, v.data_value, d.original_due_amount,
    d.current_due_amount FROM lease_invoice_detail AS d
  JOIN lease_transaction_code AS t ON t.transaction_code_oid = d.transaction_code_oid AND t.description IN ('Lease Payment', 'EFA Payment')
  LEFT JOIN lease_lti_values AS v ON v.oid = d.open_closed_oid)"""
_PAID = """(SELECT d.invoice_detail_oid, d.applied_amount, p.post_date FROM lease_payment AS p
  JOIN lease_cash_receipt_header AS h ON h.payment_oid = p.payment_oid
  JOIN lease_cash_receipt_billable AS b ON b.cash_receipt_header_oid = h.cash_receipt_header_oid
  JOIN lease_cash_receipt_detail AS d ON d.cash_receipt_billable_oid = b.cash_receipt_billable_oid
  WHERE p.is_returned = 0)"""
plans.add(
    "p21_settlement_lines",
    _SETTLE_SCHEMA,
    invoices.settlement_lines,
    f"""SELECT c.contract_oid, i.invoice_detail_oid, i.is_paid, CAST(i.due_date AS DATE) AS invoice_due_date,
          CAST(p.post_date AS DATE) AS pay_in_full_date, i.description, i.data_value AS invoice_payment_method, i.original_due_amount,
          i.current_due_amount, p.applied_amount AS total_applied_amount
        FROM lease_contract AS c LEFT JOIN {_RENT} AS i ON i.contract_oid = c.contract_oid
        LEFT JOIN {_PAID} AS p ON p.invoice_detail_oid = i.invoice_detail_oid""",
)
plans.add(
    "p21_settlement",
    _SETTLE_SCHEMA,
    invoices.settlement,
    f"""SELECT c.contract_oid, i.invoice_detail_oid, i.is_paid, CAST(i.due_date AS DATE) AS invoice_due_date,
          CAST(MAX(p.post_date) AS DATE) AS pay_in_full_date, i.description, i.data_value AS invoice_payment_method,
          i.original_due_amount, i.current_due_amount, SUM(p.applied_amount) AS total_applied_amount
        FROM lease_contract AS c LEFT JOIN {_RENT} AS i ON i.contract_oid = c.contract_oid
        LEFT JOIN {_PAID} AS p ON p.invoice_detail_oid = i.invoice_detail_oid
        GROUP BY c.contract_oid, i.invoice_detail_oid, i.is_paid, i.due_date, i.description, i.data_value, i.original_due_amount,
          i.current_due_amount""",
)

# --- payments -----------------------------------------------------------------------------

_register(
    "p08_applied_payments",
    "payment",
    "opportunity string, payment_oid bigint, reference_number string, invoice_header_oid bigint, invoice_detail_oid bigint,"
    " cash_receipt_detail_oid bigint, descr string, applied_amount double, post_date ts, effective_date ts, is_posted int,"
    " is_returned int, description string, detail_last_change_operator string, detail_last_change_datetime ts,"
    " payment_last_change_datetime ts",
    payments.applied,
    f"""SELECT o.opportunity, p.payment_oid, p.reference_number, i.invoice_header_oid, i.invoice_detail_oid, d.cash_receipt_detail_oid,
          v.descr, d.applied_amount, p.post_date, p.effective_date, p.is_posted, p.is_returned, h.description,
          d.last_change_operator AS detail_last_change_operator, d.last_change_datetime AS detail_last_change_datetime,
          p.last_change_datetime AS payment_last_change_datetime,
          {_win('d.last_change_datetime', 'p.last_change_datetime')} AS in_window
        FROM lease_payment AS p JOIN lease_contract AS c ON c.contract_oid = p.contract_oid
        LEFT JOIN lease_lti_values AS v ON v.oid = p.payment_method_oid
        LEFT JOIN lease_cash_receipt_header AS h ON h.payment_oid = p.payment_oid
        LEFT JOIN lease_cash_receipt_billable AS b ON b.cash_receipt_header_oid = h.cash_receipt_header_oid
        LEFT JOIN lease_cash_receipt_detail AS d ON d.cash_receipt_billable_oid = b.cash_receipt_billable_oid
        LEFT JOIN lease_invoice_detail AS i ON i.invoice_detail_oid = d.invoice_detail_oid
        JOIN {OPP} AS o ON o.ref_oid = c.contract_oid
        WHERE c.is_terminated = 0 AND c.is_booked = 1 AND c.company_oid = 1 AND p.is_posted = 1""",
)

_register(
    "p15_payment_key",
    "payment_key",
    "opportunity string, payment_oid bigint, amount double, last_change_operator string, last_change_datetime ts",
    payments.payment_keys,
    f"""SELECT DISTINCT o.opportunity, p.payment_oid, p.amount, p.last_change_operator, p.last_change_datetime,
          {_win('p.last_change_datetime')} AS in_window
        FROM lease_contract AS c JOIN lease_payment AS p ON p.contract_oid = c.contract_oid
        LEFT JOIN {OPP} AS o ON o.ref_oid = c.contract_oid""",
)

# --- notes --------------------------------------------------------------------------------

_NOTE_COLS = "m.oid AS comment_oid, m.ref_type, m.message_type, m.text, m.create_datetime, m.orig_user_name, m.last_change_operator, m.last_change_datetime"


def notes_sql(threshold: int) -> str:
    spans = f"""(SELECT k.entity_oid, k.contract_oid, t.start_date, COALESCE(k.termination_date, TIMESTAMP '{AS_OF}') AS until_date
      FROM lease_contract AS k JOIN lease_contract_term AS t ON t.contract_oid = k.contract_oid WHERE k.is_terminated = 0)"""
    many = f"(SELECT entity_oid FROM lease_contract GROUP BY entity_oid HAVING COUNT(*) > {threshold})"
    account = f"""FROM lease_comment AS m JOIN lease_entity AS e ON e.oid = m.ref_oid JOIN {spans} AS s
      ON s.entity_oid = e.oid AND m.create_datetime BETWEEN s.start_date AND s.until_date
      WHERE m.text IS NOT NULL AND m.ref_type = 'ACCT' AND e.oid"""
    return f"""SELECT o.opportunity, d.* EXCLUDE (contract_oid), {_win('d.last_change_datetime', start=NOTE_START, end=NOTE_END)} AS in_window
      FROM (
        SELECT c.contract_oid, c.entity_oid, {_NOTE_COLS} FROM lease_comment AS m JOIN lease_contract AS c
          ON c.contract_oid = m.ref_oid AND c.is_terminated = 0 WHERE m.text IS NOT NULL AND m.ref_type <> 'ACCT'
        UNION ALL SELECT s.contract_oid, e.oid, {_NOTE_COLS} {account} NOT IN {many}
        UNION ALL SELECT MIN(s.contract_oid), e.oid, {_NOTE_COLS} {account} IN {many} GROUP BY ALL
      ) AS d JOIN {OPP} AS o ON o.ref_oid = d.contract_oid"""


_NOTES_SCHEMA = (
    "opportunity string, comment_oid bigint, entity_oid bigint, ref_type string, message_type string, text string,"
    " create_datetime ts, orig_user_name string, last_change_operator string, last_change_datetime ts"
)
plans.add(
    "p07_notes",
    _NOTES_SCHEMA,
    lambda c: notes.notes(c, AS_OF, threshold=10),
    f"SELECT {', '.join(OBJECTS['notes'].columns)} FROM ({notes_sql(10)}) AS b",
)
_register(
    "p07_notes",
    "notes",
    _NOTES_SCHEMA,
    lambda cat, w: notes.notes(cat, AS_OF, w, threshold=1),
    notes_sql(1),
    window=NOTE_WINDOW,
    middle=NOTE_MIDDLE,
    initial=False,
)

# --- schedules ----------------------------------------------------------------------------

_BILL_BODY = f"""
  WITH item AS (
    SELECT p.schedule_definition_oid AS sid, p.payment_stream_oid, p.is_invoiced, p.occurrences * i.amount AS due,
      p.occurrences * i.on_stream_tax_amount AS tax, i.amount, i.on_stream_tax_amount
    FROM lease_payment_stream AS p LEFT JOIN lease_payment_stream_contract_item AS i ON i.payment_stream_oid = p.payment_stream_oid),
  totals AS (
    SELECT sid, SUM(due) AS due, SUM(tax) AS tax, SUM(due) + SUM(tax) AS both,
      SUM(CASE WHEN is_invoiced = 1 THEN due + tax ELSE 0 END) AS inv, SUM(CASE WHEN is_invoiced = 0 THEN due + tax ELSE 0 END) AS uninv,
      MAX(amount) AS amount, MAX(on_stream_tax_amount) AS tax_amount, MAX(amount) + MAX(on_stream_tax_amount) AS total_amount
    FROM item GROUP BY sid),
  occ AS (
    SELECT r.schedule_definition_oid AS sid, SUM(CASE WHEN p.is_invoiced = 1 THEN p.occurrences ELSE 0 END) AS inv,
      SUM(CASE WHEN p.is_invoiced = 0 THEN p.occurrences ELSE 0 END) AS uninv,
      MIN(p.start_date) FILTER (WHERE p.is_invoiced = 1) AS first_date, MAX(p.start_date) FILTER (WHERE p.is_invoiced = 0) AS next_date,
      MAX(v.descr) AS frequency
    FROM lease_recurring_billable AS r LEFT JOIN lease_payment_stream AS p ON p.schedule_definition_oid = r.schedule_definition_oid
    LEFT JOIN lease_lti_values AS v ON v.table_key = 'PYMT_FREQUENCY' AND v.data_value = p.frequency GROUP BY ALL),
  changed AS (
    SELECT r.recurring_billable_oid AS rid, MAX(
      CASE WHEN r.last_change_datetime >= p.last_change_datetime AND r.last_change_datetime >= i.last_change_datetime THEN r.last_change_datetime
        WHEN p.last_change_datetime >= r.last_change_datetime AND p.last_change_datetime >= i.last_change_datetime THEN p.last_change_datetime
        ELSE i.last_change_datetime END) AS at
    FROM lease_recurring_billable AS r LEFT JOIN lease_payment_stream AS p ON p.schedule_definition_oid = r.schedule_definition_oid
    LEFT JOIN lease_payment_stream_contract_item AS i ON i.payment_stream_oid = p.payment_stream_oid GROUP BY ALL)
  SELECT o.opportunity, r.recurring_billable_oid, t.invoice_description, r.description, r.schedule_definition_oid, r.is_following_rent,
    r.is_combined_with_rent, r.is_process_as_eft, r.is_bill_after_termination, occ.frequency, totals.due AS total_amount_due,
    totals.tax AS total_tax_amount_due, totals.both AS total_due, occ.inv AS invoiced_occurrences, totals.inv AS invoiced_total_amount,
    occ.uninv AS uninvoiced_occurrences, totals.uninv AS uninvoiced_total_amount,
    CASE WHEN occ.inv = 0 THEN occ.next_date ELSE occ.first_date END AS start_date, occ.next_date,
    CASE WHEN occ.uninv >= 1 THEN totals.amount END AS next_payment_amount,
    CASE WHEN occ.uninv >= 1 THEN totals.tax_amount END AS next_payment_tax_amount,
    CASE WHEN occ.uninv >= 1 THEN totals.total_amount END AS next_payment_total_amount,
    r.last_change_operator, changed.at AS last_change_datetime, {_win('changed.at')} AS in_window
  FROM lease_contract AS c JOIN lease_recurring_billable AS r ON r.contract_oid = c.contract_oid
  JOIN occ ON occ.sid = r.schedule_definition_oid LEFT JOIN totals ON totals.sid = r.schedule_definition_oid
  LEFT JOIN changed ON changed.rid = r.recurring_billable_oid
  LEFT JOIN lease_transaction_code AS t ON t.transaction_code_oid = r.transaction_code_oid
  JOIN {OPP} AS o ON o.ref_oid = c.contract_oid WHERE c.is_terminated = 0 AND c.is_booked = 1 AND c.company_oid = 1"""
_register(
    "p09_scheduled_billables",
    "scheduled_billables",
    "opportunity string, recurring_billable_oid bigint, invoice_description string, description string, schedule_definition_oid bigint,"
    " is_following_rent int, is_combined_with_rent int, is_process_as_eft int, is_bill_after_termination int, frequency string,"
    " total_amount_due double, total_tax_amount_due double, total_due double, invoiced_occurrences bigint, invoiced_total_amount double,"
    " uninvoiced_occurrences bigint, uninvoiced_total_amount double, start_date ts, next_date ts, next_payment_amount double,"
    " next_payment_tax_amount double, next_payment_total_amount double, last_change_operator string, last_change_datetime ts",
    schedules.scheduled_billables,
    _BILL_BODY,
)
plans.add(
    "p09_stream_billables",
    "contract_oid bigint, opportunity string, schedule_definition_oid bigint, recurring_billable_oid bigint, is_following_rent int,"
    " is_combined_with_rent int, is_process_as_eft int, is_bill_after_termination int, transaction_description string, description string,"
    " payment_stream_oid bigint, start_date ts, occurrences bigint, frequency string, is_invoiced int,"
    " payment_stream_contract_item_oid bigint, amount double, on_stream_tax_amount double, total_amount double, next_payment_date ts,"
    " last_change_datetime ts, last_change_operator string",
    lambda c: schedules.stream_billables(c, AS_OF),
    f"""SELECT r.contract_oid, o.opportunity, r.schedule_definition_oid, r.recurring_billable_oid, r.is_following_rent,
          r.is_combined_with_rent, r.is_process_as_eft, r.is_bill_after_termination, t.description AS transaction_description,
          r.description, p.payment_stream_oid, p.start_date, p.occurrences, p.frequency, p.is_invoiced,
          i.payment_stream_contract_item_oid, i.amount, i.on_stream_tax_amount, i.amount + i.on_stream_tax_amount AS total_amount,
          CASE WHEN c.is_terminated = 0 AND p.is_invoiced = 0 AND p.start_date > TIMESTAMP '{AS_OF}' THEN p.start_date END AS next_payment_date,
          p.last_change_datetime, p.last_change_operator
        FROM lease_recurring_billable AS r JOIN lease_transaction_code AS t ON t.transaction_code_oid = r.transaction_code_oid
        LEFT JOIN lease_payment_stream AS p ON p.schedule_definition_oid = r.schedule_definition_oid
        LEFT JOIN lease_payment_stream_contract_item AS i ON i.payment_stream_oid = p.payment_stream_oid
        LEFT JOIN lease_contract AS c ON c.contract_oid = r.contract_oid LEFT JOIN {OPP} AS o ON o.ref_oid = c.contract_oid
        WHERE r.description <> 'ERROR'""",
)

_TOTALS_SCHEMA = (
    "contract_oid bigint, opportunity string, total_scheduled_payments bigint, invoiced_payments bigint, uninvoiced_payments bigint,"
    " first_payment ts, next_payment ts, maturity_date ts, last_change_datetime ts, last_change_operator string"
)
_register(
    "p10_total_payments",
    "total_payments",
    _TOTALS_SCHEMA,
    schedules.total_payments,
    f"""
  WITH fine AS (
    SELECT contract_term_oid AS term, is_invoiced, last_change_datetime AS chg, last_change_operator AS who, MIN(start_date) AS lo,
      MAX(start_date) AS hi, SUM(occurrences) AS occ FROM lease_payment_stream WHERE contract_term_oid IS NOT NULL GROUP BY ALL)
  SELECT c.contract_oid, o.opportunity, a.occ AS total_scheduled_payments, i.occ AS invoiced_payments, u.occ AS uninvoiced_payments,
    i.lo AS first_payment, u.hi AS next_payment, t.maturity_date, i.chg AS last_change_datetime, i.who AS last_change_operator,
    {_win('i.chg')} AS in_window
  FROM lease_contract_term AS t JOIN lease_contract AS c ON c.contract_oid = t.contract_oid
  JOIN (SELECT term, SUM(occ) AS occ FROM fine GROUP BY term) AS a ON a.term = t.contract_term_oid
  JOIN (SELECT term, SUM(occ) AS occ, MIN(lo) AS lo, MAX(chg) AS chg, MAX(who) AS who FROM fine WHERE is_invoiced = 1 GROUP BY term) AS i
    ON i.term = t.contract_term_oid
  JOIN (SELECT term, SUM(occ) AS occ, MIN(hi) AS hi FROM fine WHERE is_invoiced = 0 GROUP BY term) AS u ON u.term = t.contract_term_oid
  JOIN {OPP} AS o ON o.ref_oid = c.contract_oid WHERE c.is_terminated = 0 AND c.is_booked = 1 AND c.company_oid = 1""",
)

# --- equipment ----------------------------------------------------------------------------


def _part(c: str) -> str:
    return f"CASE WHEN TRIM(l.{c}) <> '' THEN l.{c} || ', ' ELSE '' END"


_register(
    "p13_equipment",
    "equipment",
    "opportunity string, equipment_oid bigint, contract_item_oid bigint, serial_number string, equipment_location string,"
    " payment_amount double, payment_tax_amount double, bill_through_date ts, disposal_type string, disposal_amount double,"
    " sale_date ts, post_date ts, applied_date ts, last_change_operator string, last_change_datetime ts",
    equipment.equipment,
    f"""
  WITH place AS (
    SELECT h.equipment_oid, {_part('addr_line1')} || {_part('addr_line2')} || {_part('addr_line3')} || COALESCE(l.city, '') || ', '
      || COALESCE(l.state, '') AS address
    FROM lease_equipment_location_history AS h LEFT JOIN lease_location AS l ON l.oid = h.location_oid
    QUALIFY ROW_NUMBER() OVER (PARTITION BY h.equipment_oid ORDER BY h.start_date DESC NULLS LAST, h.location_oid NULLS LAST) = 1),
  lastitem AS (
    SELECT * FROM lease_payment_stream_contract_item QUALIFY payment_stream_contract_item_oid
      = MAX(payment_stream_contract_item_oid) OVER (PARTITION BY contract_item_oid)),
  sold AS (
    SELECT d.contract_item_oid, MAX(i.due_date) AS sale_date, MAX(h.post_date) AS post_date, MAX(h.applied_date) AS applied_date
    FROM lease_contract_disposed_asset AS d LEFT JOIN lease_invoice_detail AS i ON i.invoice_detail_oid = d.invoice_detail_oid
    LEFT JOIN lease_invoice_payment_history AS h ON h.invoice_detail_oid = i.invoice_detail_oid GROUP BY d.contract_item_oid)
  SELECT o.opportunity, e.equipment_oid, m.contract_item_oid, s.serial_number, place.address AS equipment_location,
    CASE WHEN x.is_terminated = 1 OR d.disposal_type IS NOT NULL THEN 0 ELSE x.amount END AS payment_amount,
    CASE WHEN x.is_terminated = 1 OR d.disposal_type IS NOT NULL THEN 0 ELSE x.on_stream_tax_amount END AS payment_tax_amount,
    d.bill_through_date, CASE WHEN d.disposal_type IS NULL THEN 'Not Disposed'
      WHEN d.disposal_type IN ('Sale', 'Inventory', 'Abandon') THEN d.disposal_type ELSE 'ERROR' END AS disposal_type,
    d.disposal_amount, sold.sale_date, sold.post_date, sold.applied_date, e.last_change_operator, e.last_change_datetime,
    {_win('e.last_change_datetime')} AS in_window
  FROM lease_contract AS c JOIN lease_contract_equipment AS e ON e.contract_oid = c.contract_oid
  JOIN lease_equipment_id AS s ON s.equipment_oid = e.equipment_oid
  JOIN lease_contract_item AS m ON m.contract_equipment_oid = e.contract_equipment_oid AND m.contract_item_type_oid = 1
  JOIN place ON place.equipment_oid = e.equipment_oid
  LEFT JOIN lease_contract_disposed_asset AS d ON d.contract_item_oid = m.contract_item_oid
  LEFT JOIN lastitem AS x ON x.contract_item_oid = m.contract_item_oid LEFT JOIN sold ON sold.contract_item_oid = d.contract_item_oid
  JOIN {OPP} AS o ON o.ref_oid = c.contract_oid
  WHERE c.is_booked = 1 AND c.company_oid = 1 AND c.contract_id NOT LIKE '%R%'""",
)

# --- amortization -------------------------------------------------------------------------

_AMORT_COLS = """li.line_item_oid, s.schedule_oid, CAST(li.event_date AS DATE) AS event_date, li.note AS source,
    CASE WHEN li.is_loan = 1 THEN li.event_amount ELSE 0 END AS amount_financed,
    CASE WHEN li.is_payment = 1 THEN '' ELSE CAST(CAST(li.new_rate * 100 AS DECIMAL(22,8)) AS VARCHAR){suffix} END AS rate,
    CASE WHEN li.is_payment = 1 THEN li.event_amount ELSE 0 END AS payment, li.interest_accrued AS interest, li.principal, li.balance"""
_register(
    "p16_amortization",
    "amortization",
    "opportunity string, line_item_oid bigint, schedule_oid bigint, event_date date, source string, amount_financed double, rate string,"
    " payment double, interest double, principal double, balance double, last_change_operator string, last_change_datetime ts",
    lambda cat, w: am.amortization(cat) if w is None else am.amortization(cat).filter(F.col("last_change_datetime").between(ts(w.start), ts(w.end))),
    f"""SELECT DISTINCT o.opportunity, {_AMORT_COLS.format(suffix='')}, li.last_change_operator, li.last_change_datetime,
          {_win('li.last_change_datetime')} AS in_window
        FROM lease_amort_schedule AS s JOIN lease_amort_line_item AS li ON li.schedule_oid = s.schedule_oid
        JOIN lease_contract AS c ON c.contract_oid = s.ref_oid AND c.is_booked = 1 AND c.company_oid = 1
        JOIN {OPP} AS o ON o.ref_oid = c.contract_oid WHERE s.ref_type = 1""",
)
plans.add(
    "p16_amortization_listing",
    "contract_oid bigint, schedule_oid bigint, line_item_oid bigint, event_date date, source string, amount_financed double, rate string,"
    " payment double, interest double, principal double, balance double, schedule_change ts",
    am.amortization_listing,
    f"""SELECT s.ref_oid AS contract_oid, {_AMORT_COLS.format(suffix=" || '%'")}, s.last_change_datetime AS schedule_change
        FROM lease_amort_schedule AS s JOIN lease_amort_line_item AS li ON li.schedule_oid = s.schedule_oid WHERE s.ref_type = 1""",
)

# --- tax ----------------------------------------------------------------------------------

_CODE_COLS = "r.tax_type, r.description AS rate_description"
plans.add(
    "p18_tax_detail",
    "contract_oid bigint, contract_item_oid bigint, parent_invoice_detail_oid bigint, contract_item_type_oid bigint, tax_product_oid bigint,"
    " product string, tax_jurisdiction string, applied_taxability_oid bigint, applied_tax_payment_type_oid bigint, taxable_amount double,"
    " tax_rate double, tax_amount double, applied_tax_amount double, payment_date ts, tax_code_oid bigint, tax_exception_oid bigint,"
    " exception_tax_code_oid bigint, exception_jurisdiction_oid bigint, exception_taxability_oid bigint, rate_override double,"
    " rate_adjustment double, state_name string, code string, code_description string, tax_type string, rate_description string,"
    " code_rate double, min_taxable_amount double, max_taxable_amount double",
    tax.tax_detail,
    f"""SELECT d.*, p.description AS product, v.descr AS tax_jurisdiction, a.tax_exception_oid, x.tax_code_oid AS exception_tax_code_oid,
          x.jurisdiction_oid AS exception_jurisdiction_oid, x.taxability_oid AS exception_taxability_oid, x.rate_override,
          x.rate_adjustment, s.name AS state_name, c.code, c.description AS code_description, {_CODE_COLS}, r.tax_rate AS code_rate,
          r.min_taxable_amount, r.max_taxable_amount
        FROM lease_tax_detail_finalized AS d LEFT JOIN lease_lti_values AS v ON v.oid = d.tax_jurisdiction_oid
        LEFT JOIN lease_tax_product AS p ON p.tax_product_oid = d.tax_product_oid
        LEFT JOIN lease_tax_exception_asset AS a ON a.contract_item_oid = d.contract_item_oid
        LEFT JOIN lease_tax_exception AS e ON e.tax_exception_oid = a.tax_exception_oid
        LEFT JOIN lease_tax_exception_detail AS x ON x.tax_exception_oid = a.tax_exception_oid
        LEFT JOIN lease_tax_code AS c ON c.tax_code_oid = d.tax_code_oid LEFT JOIN lease_state AS s ON s.oid = c.state_oid
        LEFT JOIN lease_tax_rate AS r ON r.tax_code_oid = c.tax_code_oid
        WHERE e.inactive_date IS NULL AND d.contract_oid <> 0""",
)
_CODES = """SELECT DISTINCT c.code, j.data_value AS jurisdiction, a.data_value AS administration, c.description, r.tax_type,
    r.description AS rate_description, r.tax_rate, r.min_taxable_amount, r.max_taxable_amount
  FROM lease_tax_code AS c LEFT JOIN lease_tax_rate AS r ON r.tax_code_oid = c.tax_code_oid
  LEFT JOIN lease_lti_values AS j ON j.oid = c.jurisdiction_oid LEFT JOIN lease_lti_values AS a ON a.oid = c.administration_oid"""
plans.add(
    "p18_tax_codes",
    "code string, jurisdiction string, administration string, description string, tax_type string, rate_description string,"
    " tax_rate double, min_taxable_amount double, max_taxable_amount double",
    tax.tax_codes,
    _CODES,
)
_APPLIED = """FROM lease_tax_detail_finalized AS d LEFT JOIN lease_tax_product AS p ON p.tax_product_oid = d.tax_product_oid
  LEFT JOIN lease_lti_values AS v1 ON v1.oid = d.applied_taxability_oid LEFT JOIN lease_lti_values AS v2 ON v2.oid = d.applied_tax_payment_type_oid"""
_APPLIED_ROWS = "d.contract_oid >= 2 AND d.contract_item_type_oid IN (1, 9)"
plans.add(
    "p18_applied_tax",
    "contract_oid bigint, contract_item_oid bigint, parent_invoice_detail_oid bigint, contract_item_type_oid bigint, tax_product_oid bigint,"
    " product string, applied_taxability string, applied_tax_payment_type string, taxable_amount double, tax_rate double,"
    " tax_amount double, applied_tax_amount double, payment_date ts, tax_code_oid bigint",
    tax.applied_tax,
    f"""SELECT d.*, p.description AS product, v1.data_value AS applied_taxability, v2.data_value AS applied_tax_payment_type
        {_APPLIED} WHERE {_APPLIED_ROWS}""",
)
plans.add(
    "p18_combined_tax",
    "contract_oid bigint, invoice_header_oid bigint, parent_invoice_detail_oid bigint, applied_taxability string",
    tax.combined_tax,
    f"""SELECT d.contract_oid, i.invoice_header_oid, d.parent_invoice_detail_oid, v1.data_value AS applied_taxability
        {_APPLIED} LEFT JOIN ({_CODES}) AS k ON k.code = CAST(d.tax_code_oid AS VARCHAR)
        LEFT JOIN lease_invoice_detail AS i ON i.invoice_detail_oid = d.parent_invoice_detail_oid WHERE {_APPLIED_ROWS}""",
)

# --- journal ------------------------------------------------------------------------------

# The vendor lookup as the oracle has it.
_VENDORS = """
    ('AK', 'V04002'), ('AL', 'V04003'), ('AR', 'V04004'), ('AZ', 'V04005'), ('CA', 'V04006'),
    ('CO', 'V04007'), ('CT', 'V04008'), ('DC', 'V04009'), ('DE', 'V04010'), ('FL', 'V04011'),
    ('GA', 'V04012'), ('HI', 'V04013'), ('IA', 'V04014'), ('ID', 'V04015'), ('IL', 'V04016'),
    ('IN', 'V04017'), ('KS', 'V04018'), ('KY', 'V04019'), ('LA', 'V04020'), ('MA', 'V04021'),
    ('MD', 'V04022'), ('ME', 'V04023'), ('MI', 'V04024'), ('MN', 'V04025'), ('MO', 'V04026'),
    ('MS', 'V04027'), ('MT', 'V04028'), ('NC', 'V04029'), ('ND', 'V04030'), ('NE', 'V04031'),
    ('NH', 'V04032'), ('NJ', 'V04033'), ('NM', 'V04034'), ('NV', 'V04035'), ('NY', 'V04036'),
    ('OH', 'V04037'), ('OK', 'V04038'), ('OR', 'V04039'), ('PA', 'V04040'), ('RI', 'V04041'),
    ('SC', 'V04042'), ('SD', 'V04043'), ('TN', 'V04044'), ('TX', 'V04045'), ('UT', 'V04046'),
    ('VA', 'V04047'), ('VT', 'V04048'), ('WA', 'V04049'), ('WI', 'V04050'), ('WV', 'V04051'),
    ('WY', 'V04052')"""
_NAME_PARTS = " || ".join(
    f"CASE WHEN TRIM(COALESCE(e.{p}, '')) = '' THEN '' ELSE TRIM(e.{p}) || ' ' END" for p in ("fname", "mname", "lname", "suffix")
)
_GROUPED = f"""
  SELECT g.journal_number, g.post_date, g.account_id, t.account_title, c.contract_id, g.process_oid, v.descr AS transaction_type,
    CASE WHEN e.bus_or_ind = 'B' THEN TRIM(e.name) ELSE RTRIM({_NAME_PARTS}) END AS name,
    CASE WHEN c.contract_id LIKE '%R%' THEN 'Rebook' WHEN c.contract_id LIKE '%E%' THEN 'EFA' ELSE 'Lease' END AS contract_type,
    CASE WHEN g.account_id = '01-10108' THEN l.state END AS state, LEFT(t.account_title, 5) AS title_account, w.reason,
    SUM(g.debit) AS debit_sum, COALESCE(SUM(g.debit), 0) + COALESCE(SUM(g.credit), 0) AS net
  FROM lease_general_ledger AS g
  JOIN lease_general_ledger_reference AS f ON f.general_ledger_reference_oid = g.general_ledger_reference_oid AND f.company_oid = 1
  LEFT JOIN lease_general_ledger_account_id AS a ON a.general_ledger_account_id_oid = g.general_ledger_account_id_oid
  LEFT JOIN lease_gl_accounts AS t ON t.gl_accounts_oid = a.gl_accounts_oid
  LEFT JOIN lease_contract AS c ON c.contract_oid = a.contract_oid LEFT JOIN lease_entity AS e ON e.oid = c.entity_oid
  LEFT JOIN lease_invoice_detail AS i ON i.invoice_detail_oid = f.invoice_detail_oid LEFT JOIN lease_location AS l ON l.oid = i.location_oid
  LEFT JOIN lease_lti_values AS v ON v.oid = g.process_oid
  LEFT JOIN (SELECT DISTINCT r.contract_oid, r.type_oid, r.reason_code_oid, k.data_value AS reason FROM lease_contract_rewrite AS r
     JOIN lease_lti_values AS k ON k.oid = r.reason_code_oid WHERE k.data_value IN ('EOL', 'ES', 'IC', 'UW', 'I', 'CO')) AS w
    ON w.contract_oid = c.contract_oid
  WHERE g.post_date > TIMESTAMP '1998-09-30' AND g.post_date <= TIMESTAMP '1998-10-31' GROUP BY ALL"""
_SPLIT = f"""
  SELECT *, CASE WHEN net >= 0 THEN net END AS debit, CASE WHEN net < 0 THEN -net END AS credit, COALESCE(state, 'E-100') AS location,
    CASE WHEN title_account = '42001' AND net >= 0 THEN '14000'
      WHEN title_account = '42001' AND reason IN ('I', 'CO') AND COALESCE(debit_sum, 0) = 0 THEN '42002' ELSE title_account END AS account,
    CASE WHEN process_oid = 20119 THEN 'BKJ' WHEN process_oid IN (20120, 20121) THEN 'ASBJ'
      WHEN process_oid IN (20122, 20134, 20135) THEN 'ACRJ' WHEN process_oid = 20123 THEN 'ABAJ'
      WHEN process_oid IN (20126, 20127) THEN 'AMJ' WHEN process_oid IN (20140, 20141) THEN 'CMJ' WHEN process_oid = 20128 THEN 'ACJ'
      WHEN process_oid = 20143 THEN 'DPJ' END AS journal
  FROM ({_GROUPED}) AS grouped"""
_JOURNAL_SCHEMA = (
    "donotimport string, journal string, date string, description string, line_no bigint, acct_no string, location_id string, dept_id int,"
    " memo string, transaction_type string, debit double, credit double, currency string, state string, project_id string,"
    " vendor_id string, journal_number bigint"
)


def journal_sql(extra: str = "TRUE", tx_drafts: bool = True) -> str:
    draft = "account_id IN ('01-20025', '01-10040') OR process_oid IN (20119, 20121, 20143) OR contract_id IS NULL"
    if tx_drafts:
        draft += " OR transaction_type IN ('Miscellaneous Billing', 'Booking Adjustment')"
    zero = "CASE WHEN process_oid = 20119 AND account_id IN ('01-10094', '01-10002') THEN 0 ELSE {0} END"
    order = ", ".join(
        f"{c} NULLS FIRST"
        for c in "post_date contract_id account account_id account_title process_oid transaction_type name location reason".split()
    )
    return f"""
      SELECT '' AS donotimport, journal, STRFTIME(post_date, '%m/%d/%Y') AS date, 'Journal ' || journal_number AS description,
        ROW_NUMBER() OVER (PARTITION BY journal_number ORDER BY {order}) AS line_no, account AS acct_no, location AS location_id,
        10 AS dept_id, contract_type || ' #' || contract_id || ' ' || name || ' - ' || transaction_type AS memo, transaction_type,
        {zero.format('debit')} AS debit, {zero.format('credit')} AS credit, 'USD' AS currency,
        CASE WHEN {draft} THEN 'Draft' ELSE 'Post' END AS state, contract_id AS project_id,
        CASE WHEN account = '20007' THEN 'V00296' WHEN account = '20006' THEN vend.vendor END AS vendor_id, journal_number
      FROM ({_SPLIT}) AS j LEFT JOIN (VALUES {_VENDORS}) AS vend(sut_state, vendor) ON vend.sut_state = j.location
      WHERE ({zero.format('debit')} <> 0 OR {zero.format('credit')} <> 0) AND {extra}
        AND NOT ((transaction_type LIKE '%Adj%' OR transaction_type LIKE '%MOD%') AND account IN ('11004', '14006'))"""


plans.add("p19_journal_export", _JOURNAL_SCHEMA, lambda c: journal.journal_export(c, JOURNAL_MONTH), journal_sql())
plans.add(
    "p19_rental_income_journal",
    _JOURNAL_SCHEMA,
    lambda c: journal.journal_export(c, JOURNAL_MONTH, journal.NARROW_ACCOUNTS, simple_state=True),
    journal_sql("account IN ('42001', '42002')", tx_drafts=False),
)
plans.add(
    "p19_rental_income_check",
    "journal_number bigint, post_date ts, account_id string, account_title string, debit double, credit double, contract_id string,"
    " name string, contract_type string, process_oid bigint, transaction_type string, location string, account string, journal string,"
    " reason string",
    lambda c: journal.rental_income_check(c, JOURNAL_MONTH),
    f"SELECT * FROM ({_SPLIT}) AS j WHERE title_account = '42001' AND debit_sum IS NULL",
)

# --- delinquency --------------------------------------------------------------------------


def delinquency_sql(as_of: str) -> str:
    return f"""
  WITH lines AS (
    SELECT d.contract_oid, d.current_due_amount AS amt, d.due_date, d.transaction_code_oid AS code FROM lease_invoice_detail AS d
    JOIN lease_invoice_header AS h ON h.invoice_header_oid = d.invoice_header_oid AND h.is_posted = 1
    WHERE d.open_closed_oid NOT IN (11022, 11023) AND d.current_due_amount <> 0
      AND d.transaction_code_oid IN (SELECT transaction_code_oid FROM lease_transaction_code)),
  due AS (
    SELECT contract_oid, SUM(amt) FILTER (WHERE code IN (1, 35, 4) AND due_date >= TIMESTAMP '{as_of}') AS current_due,
      SUM(amt) FILTER (WHERE code IN (1, 35, 4) AND due_date < TIMESTAMP '{as_of}') AS past_due,
      SUM(amt) FILTER (WHERE code NOT IN (1, 35, 4)) AS misc_due, SUM(amt) AS total_due,
      MAX(due_date) FILTER (WHERE code IN (1, 35)) AS oldest_rent_due
    FROM lines GROUP BY contract_oid),
  good AS (SELECT * FROM lease_payment WHERE is_posted = 1 AND is_returned = 0),
  last_paid AS (SELECT contract_oid, reference_number, effective_date FROM good
    QUALIFY effective_date = MAX(effective_date) OVER (PARTITION BY contract_oid)),
  ret AS (SELECT contract_oid, COUNT(is_returned) AS payments_returned FROM lease_payment GROUP BY contract_oid),
  upcoming AS (
    SELECT p.contract_oid, p.start_date, i.amount, i.on_stream_tax_amount FROM lease_payment_stream AS p
    JOIN lease_payment_stream_contract_item AS i ON i.payment_stream_oid = p.payment_stream_oid
    WHERE p.contract_term_oid IS NOT NULL AND p.is_invoiced = 0),
  nxt AS (
    SELECT contract_oid, SUM(amount) AS amount, SUM(on_stream_tax_amount) AS tax FROM (
      SELECT * FROM upcoming QUALIFY start_date = MIN(start_date) OVER (PARTITION BY contract_oid)) AS u GROUP BY contract_oid)
  SELECT c.contract_oid, c.contract_id, o.opportunity, due.current_due, due.past_due, due.misc_due, due.total_due, due.oldest_rent_due,
    CASE WHEN due.oldest_rent_due >= TIMESTAMP '{as_of}' THEN 0
      ELSE DATE_DIFF('day', due.oldest_rent_due, TIMESTAMP '{as_of}') END AS days_delinquent,
    last_paid.effective_date, last_paid.reference_number, ret.payments_returned, nxt.amount AS payment_amount, nxt.tax AS payment_tax,
    nxt.amount + nxt.tax AS payment_total
  FROM lease_contract AS c LEFT JOIN {OPP} AS o ON o.ref_oid = c.contract_oid LEFT JOIN due ON due.contract_oid = c.contract_oid
  LEFT JOIN last_paid ON last_paid.contract_oid = c.contract_oid LEFT JOIN ret ON ret.contract_oid = c.contract_oid
  LEFT JOIN nxt ON nxt.contract_oid = c.contract_oid WHERE c.is_booked = 1 AND c.company_oid = 1"""


_DEL_SCHEMA = (
    "contract_oid bigint, contract_id string, opportunity string, current_due double, past_due double, misc_due double, total_due double,"
    " oldest_rent_due ts, days_delinquent bigint, effective_date ts, reference_number string, payments_returned bigint,"
    " payment_amount double, payment_tax double, payment_total double"
)


def _earlier_counts(cat: StarCatalog) -> DataFrame:
    """Returned-payment counts as they stood at the earlier clock."""
    old = cat.read("payment").filter(F.col("post_date") <= ts(PREV_AS_OF))
    return old.groupBy("contract_oid").agg(F.count("is_returned").alias("payments_returned"))


plans.add("p20_delinquency", _DEL_SCHEMA, lambda c: delinquency.delinquency(c, AS_OF), delinquency_sql(AS_OF))
plans.add(
    "p20_delinquency_changes",
    f"change_status string, {_DEL_SCHEMA}",
    lambda c: delinquency.delinquency(c, AS_OF, _earlier_counts(c)),
    f"""SELECT d.*, CASE WHEN d.payments_returned <> p.n THEN 'Data Changed' ELSE 'No Changes' END AS change_status
        FROM ({delinquency_sql(AS_OF)}) AS d LEFT JOIN (
          SELECT contract_oid, COUNT(is_returned) AS n FROM lease_payment WHERE post_date <= TIMESTAMP '{PREV_AS_OF}'
          GROUP BY contract_oid) AS p ON p.contract_oid = d.contract_oid""",
)
plans.add(
    "p22_gross_definition_check",
    "contract_oid bigint, gross_receivable double, gross_receivable_narrow double",
    acc.gross_definition_check,
    """SELECT c.contract_oid, COALESCE(SUM(x.amt) FILTER (WHERE x.p IN (20119, 20126, 20127, 20140, 20141)), 0) AS gross_receivable,
          COALESCE(SUM(x.amt) FILTER (WHERE x.p IN (20119, 20126, 20127)), 0) AS gross_receivable_narrow
        FROM lease_contract AS c LEFT JOIN (
          SELECT a.contract_oid, g.process_oid AS p, COALESCE(g.debit, 0) + COALESCE(g.credit, 0) AS amt FROM lease_general_ledger AS g
          JOIN lease_general_ledger_account_id AS a ON a.general_ledger_account_id_oid = g.general_ledger_account_id_oid
          WHERE g.account_id = '01-10089') AS x ON x.contract_oid = c.contract_oid
        WHERE c.is_booked = 1 AND c.company_oid = 1 AND c.is_terminated = 1 GROUP BY c.contract_oid
        HAVING gross_receivable <> gross_receivable_narrow""",
)

# --- publication --------------------------------------------------------------------------

_PUBLISHED_PLANS = {
    "accounting": ("p01_accounting_snapshot", lambda c: acc.accounting(c, AS_OF)),
    "eft_alt_schedule": ("p04_alternate_schedule", banking.alternate_schedules),
    "eft_assignment": ("p05_auto_debit_assignment", banking.assignments),
    "equipment": ("p13_equipment", equipment.equipment),
    "invoice": ("p06_invoice_lines", invoices.invoice_lines),
    "notes": (None, lambda c: notes.notes(c, AS_OF)),
    "payment": ("p08_applied_payments", lambda c: payments.applied(c).filter(F.col("cash_receipt_detail_oid").isNotNull())),
    "scheduled_billables": ("p09_scheduled_billables", schedules.scheduled_billables),
    "total_payments": ("p10_total_payments", schedules.total_payments),
    "phone": ("p12_phone", contracts.phones),
    "amortization": ("p16_amortization", am.amortization),
    "collector": ("p02_collector", contracts.collectors),
    "contract": ("p03_contract", contracts.contracts),
}


def _published(cat: StarCatalog) -> DataFrame:
    """Publish every registered object and list what landed: object, key field and row count."""
    staged = {n: build(cat) for n, (_, build) in _PUBLISHED_PLANS.items()}
    paths = publish_all(staged, scratch_path(cat.spark, "publish"), "b1")
    keys = dict(PUBLISHED)
    landed = []
    for n, path in paths.items():
        count = cat.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("batch_rows"))
        landed.append(count.selectExpr(f"'{n}' AS object", f"'{OBJECTS[n].fields[keys[n]]}' AS key_field", "batch_rows"))
    return union_arms(*landed)


def _published_sql() -> str:
    arms = []
    for n, key in PUBLISHED:
        name = _PUBLISHED_PLANS[n][0]
        body = notes_sql(1) if name is None else plans.items[name].sql
        arms.append(
            f"SELECT '{n}' AS object, '{OBJECTS[n].fields[key]}' AS key_field, COUNT(*) AS batch_rows FROM ({body}) AS b WHERE {key} IS NOT NULL"
        )
    return " UNION ALL ".join(arms)


plans.add("p23_published_batches", "object string, key_field string, batch_rows bigint", _published, _published_sql())
