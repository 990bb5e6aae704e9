"""Lease-shaped views over the star-schema test tables.

Each view is one SQL text that Spark and any ANSI engine read alike; ``{orders}``
and the like stand for the star tables. The pipelines only see the lease tables,
so the same code runs on a real ledger through ``TableCatalog``.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ledgersync.schemas import LEASE_DDL, STAR_DDL, columns_of
from ledgersync.sources.catalog import TableCatalog
from ledgersync.sources.inline import vendor_rows

# Shorthands expanded in the view texts below.
_MACROS = {
    "@PRICE": "CAST(l_extendedprice AS DECIMAL(18,2))",
    "@TAX": "CAST(l_tax * 100 AS DECIMAL(18,2))",
    "@KEY": "(l_orderkey * 10 + l_linenumber)",
    # Least and greatest flag or status, taken over numbers (text extremes would force sorted aggregation).
    "@MINFLAG": "(CASE MIN(@FLAG) WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END)",
    "@MAXFLAG": "(CASE MAX(@FLAG) WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END)",
    "@MINSTATUS": "(CASE MIN(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END) WHEN 0 THEN 'F' ELSE 'O' END)",
    "@MAXSTATUS": "(CASE MAX(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END) WHEN 0 THEN 'F' ELSE 'O' END)",
    "@FLAG": "(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END)",
    "@PRIO": "CAST(SUBSTR(o_orderpriority, 1, 1) AS INT)",
    "@TOTAL": "CAST(o_totalprice AS DECIMAL(18,2))",
}


def _values(alias: str, rows: list[tuple]) -> str:
    def lit(v: Any) -> str:
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({alias})"


_LTI = [
    (11020, "OPEN_CLOSED", "Check", "Open"),
    (11021, "OPEN_CLOSED", "Wire", "Partially open"),
    (11022, "OPEN_CLOSED", "ACH", "Closed"),
    (11023, "OPEN_CLOSED", "Write-off", "Written off"),
    (9001, "PYMT_METHOD", "CHK", "Check"),
    (9002, "PYMT_METHOD", "ACH", "Auto debit"),
    (9003, "PYMT_METHOD", "WIR", "Wire"),
    (1, "PYMT_FREQUENCY", "1", "Monthly"),
    (2, "PYMT_FREQUENCY", "3", "Quarterly"),
    (3, "PYMT_FREQUENCY", "12", "Annual"),
    (11, "TAX_TREATMENT", "F", "Upfront"),
    (12, "TAX_TREATMENT", "O", "On stream"),
    (21, "ACCT_CATEGORY", "B", "Business"),
    (22, "ACCT_CATEGORY", "P", "Personal"),
    (23, "ACCT_TYPE", "C", "Checking"),
    (24, "ACCT_TYPE", "S", "Savings"),
    (31, "RewriteReason", "EOL", "End of lease"),
    (32, "RewriteReason", "ES", "Early settlement"),
    (33, "RewriteReason", "I", "Insurance"),
    (34, "RewriteReason", "CO", "Charge off"),
    (35, "RewriteReason", "XX", "Other"),
    (41, "TaxJurisdiction", "S", "State"),
    (42, "TaxJurisdiction", "C", "County"),
    (43, "TaxAdministration", "DOR", "Department of revenue"),
    (44, "TaxAdministration", "CTY", "City"),
    (45, "Taxability", "T", "Taxable"),
    (46, "Taxability", "E", "Exempt"),
    (47, "TaxPaymentType", "UP", "Upfront"),
    (48, "TaxPaymentType", "ST", "Stream"),
    (51, "EVENT", "click", "Click"),
    (52, "EVENT", "view", "View"),
    (53, "EVENT", "purchase", "Purchase"),
    (20119, "PROCESS", "BK", "Booking"),
    (20120, "PROCESS", "SL", "Asset Sale"),
    (20121, "PROCESS", "SA", "Asset Sale Adj"),
    (20122, "PROCESS", "AC", "Accrual"),
    (20123, "PROCESS", "MB", "Miscellaneous Billing"),
    (20126, "PROCESS", "AM", "Amortization"),
    (20127, "PROCESS", "AX", "Amortization MOD"),
    (20128, "PROCESS", "CA", "Cash Application"),
    (20134, "PROCESS", "AR", "Accrual Reversal"),
    (20135, "PROCESS", "AD", "Accrual Adj"),
    (20140, "PROCESS", "BA", "Booking Adjustment"),
    (20141, "PROCESS", "CM", "Credit Memo"),
    (20143, "PROCESS", "DP", "Disposal"),
]

# Account titles per (line number, return flag); the first five characters are the export account.
_TITLES = [
    (3, "14006 Lease receivable"), (4, "11004 Lease receivable adj"), (5, "14006 Lease receivable"),
    (6, "42001 Rental income"), (7, "42001 Rental income"), (8, "42001 Rental income"),
    (9, "15001 Residual"), (10, "15001 Residual"), (11, "15001 Residual"),
    (12, "24001 Unearned"), (13, "24001 Unearned"), (14, "24001 Unearned"),
    (15, "15009 Deferred residual"), (16, "15009 Deferred residual"), (17, "15009 Deferred residual"),
    (18, "18001 Deferred expense"), (19, "18001 Deferred expense"), (20, "18001 Deferred expense"),
    (21, "21000 Deposit"), (22, "20006 Sales tax payable"), (23, "20007 Use tax payable"),
]

def _state_case(key: str) -> str:
    """Every vendor state in turn, and some rows without one."""
    return f"CASE {key} % 60 " + " ".join(f"WHEN {i} THEN '{s}'" for i, (s, _) in enumerate(vendor_rows())) + " END"


STAR_VIEWS: dict[str, str] = {
    "contract": """
        SELECT o_orderkey AS contract_oid,
          (CASE @PRIO WHEN 1 THEN 'R' WHEN 2 THEN 'E' ELSE 'L' END) || CAST(o_orderkey AS STRING) AS contract_id,
          o_custkey AS entity_oid, CASE WHEN o_totalprice < 50000 THEN 2 ELSE 1 END AS company_oid,
          CASE WHEN o_totalprice > 470000 THEN 0 ELSE 1 END AS is_booked,
          CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_terminated,
          CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 400 DAY
               WHEN @PRIO = 5 THEN o_orderdate + INTERVAL 800 DAY END AS termination_date,
          o_custkey AS bill_to_location_oid, o_custkey + 1 AS tax_location_oid,
          CASE WHEN @PRIO = 3 THEN 35 ELSE 1 END AS transaction_code_oid, @PRIO AS invoice_code_oid,
          @PRIO AS invoice_lead_days_oid, @PRIO AS cash_application_code_oid, o_orderstatus AS tax_treatment,
          CAST(@PRIO * 0.0125 AS DECIMAL(18,8)) AS implicit_rate, CASE WHEN @PRIO = 4 THEN 1 ELSE 0 END AS is_suspend_invoice,
          CASE WHEN @PRIO = 5 THEN 1 ELSE 0 END AS is_non_accrual,
          CASE WHEN @PRIO = 5 THEN o_orderdate + INTERVAL 90 DAY END AS non_accrual_effective_date,
          o_orderpriority AS last_change_operator, o_orderdate + INTERVAL 30 DAY AS last_change_datetime
        FROM {orders}""",
    "contract_term": """
        SELECT o_orderkey AS contract_term_oid, o_orderkey AS contract_oid, o_orderdate + INTERVAL 9 HOUR AS start_date,
          o_orderdate + INTERVAL 1800 DAY AS maturity_date, CAST(@PRIO * 0.011 AS DECIMAL(18,8)) AS internal_yield_rate
        FROM {orders}""",
    "general_ledger": """
        SELECT @KEY AS general_ledger_oid, @KEY * 3 + @FLAG AS general_ledger_account_id_oid,
          @KEY AS general_ledger_reference_oid,
          CASE WHEN l_linenumber = 1 THEN '01-10089' WHEN l_linenumber = 2 THEN '01-10090'
               WHEN l_linenumber = 3 THEN '01-10091' WHEN l_linenumber = 4 THEN '01-10092'
               WHEN l_linenumber = 5 THEN '01-10093' WHEN l_linenumber = 6 THEN '01-10094'
               WHEN l_returnflag = 'A' THEN '01-10130' WHEN l_returnflag = 'N' THEN '01-10108'
               ELSE '01-20025' END AS account_id,
          CASE WHEN EXTRACT(DAY FROM l_shipdate) <= 6 THEN 20119 WHEN EXTRACT(DAY FROM l_shipdate) <= 10 THEN 20126
               WHEN EXTRACT(DAY FROM l_shipdate) <= 13 THEN 20127 WHEN EXTRACT(DAY FROM l_shipdate) <= 16 THEN 20140
               WHEN EXTRACT(DAY FROM l_shipdate) <= 18 THEN 20141 WHEN EXTRACT(DAY FROM l_shipdate) <= 21 THEN 20143
               WHEN EXTRACT(DAY FROM l_shipdate) <= 24 THEN 20120 WHEN EXTRACT(DAY FROM l_shipdate) = 25 THEN 20121
               WHEN EXTRACT(DAY FROM l_shipdate) = 26 THEN 20122 WHEN EXTRACT(DAY FROM l_shipdate) = 27 THEN 20123
               WHEN EXTRACT(DAY FROM l_shipdate) = 28 THEN 20128 WHEN EXTRACT(DAY FROM l_shipdate) = 29 THEN 20134
               WHEN EXTRACT(DAY FROM l_shipdate) = 30 THEN 20135 ELSE 20999 END AS process_oid,
          l_suppkey AS journal_number, l_shipdate AS post_date,
          CASE WHEN l_linestatus = 'O' THEN @PRICE END AS debit, CASE WHEN l_linestatus = 'F' THEN -@PRICE END AS credit
        FROM {lineitem}""",
    "general_ledger_account_id": """
        SELECT DISTINCT @KEY * 3 + @FLAG AS general_ledger_account_id_oid, l_orderkey AS contract_oid,
          l_linenumber * 3 + @FLAG AS gl_accounts_oid FROM {lineitem}""",
    "gl_accounts": _values("gl_accounts_oid, account_title", _TITLES),
    "general_ledger_reference": """
        SELECT DISTINCT @KEY AS general_ledger_reference_oid, @KEY AS invoice_detail_oid,
          CASE WHEN l_linenumber = 5 THEN 2 ELSE 1 END AS company_oid FROM {lineitem}""",
    "invoice_header": """
        SELECT l_orderkey * 10 + l_linenumber % 3 AS invoice_header_oid, l_orderkey AS contract_oid,
          MIN(l_shipdate) AS invoice_date, MIN(l_shipdate) + INTERVAL 30 DAY AS due_date,
          CASE WHEN MAX(l_tax) > 0.01 THEN 1 ELSE 0 END AS is_posted, @MAXFLAG AS last_change_operator,
          MAX(l_shipdate) AS last_change_datetime
        FROM {lineitem} GROUP BY l_orderkey, l_orderkey * 10 + l_linenumber % 3""",
    "invoice_detail": """
        SELECT @KEY AS invoice_detail_oid, l_orderkey * 10 + l_linenumber % 3 AS invoice_header_oid,
          l_orderkey AS contract_oid, @KEY AS contract_item_oid,
          CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 35 WHEN 3 THEN 25 WHEN 4 THEN 4 WHEN 5 THEN 37 WHEN 6 THEN 43
               ELSE 99 END AS transaction_code_oid,
          CASE WHEN @MINFLAG = 'R' THEN 11022 WHEN @MINFLAG = 'N' THEN 11021 ELSE 11020 END AS open_closed_oid,
          MIN(-1 - l_suppkey) AS location_oid, CAST(SUM(@PRICE) AS DECIMAL(18,2)) AS original_due_amount,
          CAST(SUM(CASE WHEN l_linestatus = 'O' THEN @PRICE ELSE 0 END) AS DECIMAL(18,2)) AS current_due_amount,
          MIN(l_shipdate) AS due_date, CASE WHEN @MAXSTATUS = 'F' THEN 1 ELSE 0 END AS is_paid,
          @MAXFLAG AS last_change_operator, MAX(l_shipdate) AS last_change_datetime
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "invoice_payment_history": """
        SELECT @KEY AS invoice_detail_oid, @PRICE AS applied_amount, l_shipdate + INTERVAL 5 DAY AS applied_date,
          l_shipdate + INTERVAL 6 DAY AS post_date FROM {lineitem} WHERE l_linestatus = 'F'""",
    "payment": """
        SELECT @KEY AS payment_oid, l_orderkey AS contract_oid, 'REF' || CAST(MAX(l_partkey) AS STRING) AS reference_number,
          CASE @MINFLAG WHEN 'A' THEN 9001 WHEN 'N' THEN 9002 ELSE 9009 END AS payment_method_oid,
          CAST(SUM(@PRICE) AS DECIMAL(18,2)) AS amount, MAX(l_shipdate) + INTERVAL 6 DAY AS post_date,
          MAX(l_shipdate) + INTERVAL 5 DAY AS effective_date, CASE WHEN MAX(l_quantity) > 3 THEN 1 ELSE 0 END AS is_posted,
          CASE @MINFLAG WHEN 'R' THEN 1 WHEN 'N' THEN 0 WHEN 'A' THEN CASE WHEN MAX(l_tax) > 0.04 THEN 0 END END AS is_returned,
          @MAXFLAG AS last_change_operator, MAX(l_shipdate) AS last_change_datetime
        FROM {lineitem} WHERE l_linestatus = 'F' GROUP BY l_orderkey, l_linenumber""",
    "cash_receipt_header": """
        SELECT DISTINCT @KEY AS cash_receipt_header_oid, @KEY AS payment_oid, 'Receipt ' || CAST(l_linenumber AS STRING) AS description
        FROM {lineitem} WHERE l_linestatus = 'F'""",
    "cash_receipt_billable": """
        SELECT DISTINCT @KEY AS cash_receipt_billable_oid, @KEY AS cash_receipt_header_oid FROM {lineitem} WHERE l_linestatus = 'F'""",
    "cash_receipt_detail": """
        SELECT @KEY * 3 + @FLAG AS cash_receipt_detail_oid, @KEY AS cash_receipt_billable_oid, @KEY AS invoice_detail_oid,
          CAST(SUM(@PRICE) AS DECIMAL(18,2)) AS applied_amount, @MAXFLAG AS last_change_operator,
          MAX(l_shipdate) + INTERVAL 2 DAY AS last_change_datetime
        FROM {lineitem} WHERE l_linestatus = 'F' AND l_discount > 0
        GROUP BY l_orderkey, l_linenumber, l_returnflag""",
    "payment_stream": """
        SELECT @KEY AS payment_stream_oid, l_orderkey AS contract_oid,
          CASE WHEN l_linenumber = 6 THEN NULL ELSE l_orderkey END AS contract_term_oid,
          l_orderkey * 10 + l_linenumber % 2 AS schedule_definition_oid, MIN(l_shipdate) AS start_date,
          CAST(SUM(l_quantity) AS BIGINT) AS occurrences, CASE l_linenumber % 2 WHEN 0 THEN '1' ELSE '3' END AS frequency,
          CASE WHEN @MINSTATUS = 'F' THEN 1 ELSE 0 END AS is_invoiced, @MAXFLAG AS last_change_operator,
          MAX(l_shipdate) AS last_change_datetime
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "payment_stream_contract_item": """
        SELECT @KEY * 3 + @FLAG AS payment_stream_contract_item_oid, @KEY AS payment_stream_oid, @KEY AS contract_item_oid,
          CASE WHEN l_linenumber = 7 THEN NULL ELSE MAX(@PRICE) END AS amount,
          CAST(SUM(@TAX) AS DECIMAL(18,2)) AS on_stream_tax_amount,
          CASE WHEN MAX(l_discount) > 0.08 THEN 1 ELSE 0 END AS is_terminated, MAX(l_shipdate) AS last_change_datetime
        FROM {lineitem} WHERE l_discount > 0.01 GROUP BY l_orderkey, l_linenumber, l_returnflag""",
    "recurring_billable": """
        SELECT l_orderkey * 10 + l_linenumber % 2 AS recurring_billable_oid, l_orderkey AS contract_oid,
          l_orderkey * 10 + l_linenumber % 2 AS schedule_definition_oid,
          CASE l_linenumber % 2 WHEN 0 THEN 1 ELSE 35 END AS transaction_code_oid, @MINFLAG AS description,
          CASE WHEN @MINFLAG = 'A' THEN 1 ELSE 0 END AS is_following_rent,
          CASE WHEN @MAXFLAG = 'R' THEN 1 ELSE 0 END AS is_combined_with_rent,
          CASE WHEN MAX(l_tax) > 0.05 THEN 1 ELSE 0 END AS is_process_as_eft,
          CASE WHEN MAX(l_discount) > 0.05 THEN 1 ELSE 0 END AS is_bill_after_termination,
          @MAXSTATUS AS last_change_operator, MIN(l_shipdate) AS last_change_datetime
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber % 2""",
    "transaction_code": _values(
        "transaction_code_oid, description, invoice_description",
        [(1, "Lease Payment", "Rent"), (35, "EFA Payment", "Loan payment"), (25, "Late Fee", "Late fee"),
         (4, "Sales Tax", "Tax"), (37, "Interim Rent", "Interim"), (43, "Documentation Fee", "Doc fee")],
    ),
    "invoice_code": _values("invoice_code_oid, description", [(1, "Single"), (2, "Combined"), (3, "Email"), (4, "None")]),
    "invoice_lead_days": _values("invoice_lead_days_oid, description", [(1, "10 days"), (2, "20 days"), (3, "30 days")]),
    "cash_application_code": _values("cash_application_code_oid, description", [(1, "Oldest first"), (2, "Rent first")]),
    "lti_values": _values("oid, table_key, data_value, descr", _LTI),
    "generic_field": _values("oid, descr", [(23, "Opportunity"), (24, "Region")]),
    "generic_value": """
        SELECT 23 AS genf_oid, o_orderkey AS ref_oid,
          CASE WHEN o_totalprice < 60000 THEN NULL ELSE 'OPP' || CAST(o_orderkey AS STRING) END AS field_value
        FROM {orders} WHERE o_orderpriority <> '4-NOT SPECIFIED'
        UNION ALL SELECT 23, o_orderkey, 'OPP' || CAST(o_orderkey AS STRING) FROM {orders} WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 60000
        UNION ALL SELECT 24, o_orderkey, o_orderpriority FROM {orders}""",
    "entity": """
        SELECT c_custkey AS oid, c_name AS name, c_name || ' LLC' AS legal_name,
          CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS alt_name,
          CASE WHEN c_acctbal < 0 THEN ' ' ELSE ' ' || LOWER(c_mktsegment) END AS fname,
          CASE WHEN c_acctbal > 5000 THEN 'Q ' END AS mname, SUBSTR(c_name, 1, 8) AS lname,
          CASE WHEN c_acctbal > 9000 THEN 'Jr' ELSE '' END AS suffix,
          CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'B' ELSE 'I' END AS bus_or_ind,
          LOWER(c_name) || '@example.com' AS email_addr,
          CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS collector_oid,
          CASE WHEN c_acctbal > 3000 THEN 1 ELSE 0 END AS permanent_collection_assignment_flag,
          c_mktsegment AS last_change_operator,
          CAST('1999-01-01 00:00:00' AS TIMESTAMP) + c_nationkey * INTERVAL '1' DAY AS last_change_datetime
        FROM {customer}""",
    "child_entity": """
        SELECT o_orderkey AS ref_oid, o_custkey AS entt_oid, 1 AS role_oid, 'cust' AS role_type FROM {orders}
        UNION ALL SELECT o_orderkey, o_custkey + 1, 2, 'guar' FROM {orders} WHERE o_orderstatus = 'O'
        UNION ALL SELECT o_orderkey, o_custkey + 2, 3, 'brok' FROM {orders} WHERE o_orderstatus = 'P'""",
    "role": _values("oid, descr", [(1, "Customer"), (2, "Guarantor"), (3, "Broker"), (4, "Contract Manager"), (5, "Collector")]),
    "phone": """
        SELECT c_custkey * 2 AS oid, c_custkey AS entt_oid, 'Office' AS phone_type,
          CAST(7015550000 + c_custkey AS STRING) AS phone_num, CASE WHEN c_acctbal > 0 THEN '12' END AS extension,
          1 AS is_primary, c_mktsegment AS last_change_operator,
          CAST('1999-01-01 00:00:00' AS TIMESTAMP) + c_nationkey * INTERVAL '1' DAY AS last_change_datetime FROM {customer}
        UNION ALL SELECT c_custkey * 2 + 1, c_custkey, NULL, CAST(2185550000 + c_custkey AS STRING), NULL, 0, c_mktsegment,
          CAST('1999-01-15 00:00:00' AS TIMESTAMP) FROM {customer} WHERE c_acctbal > 2000""",
    "location": f"""
        SELECT c_custkey AS oid, c_name AS addr_line1, CASE WHEN c_acctbal < 0 THEN NULL ELSE ' Unit ' || c_mktsegment END AS addr_line2,
          CAST(NULL AS STRING) AS addr_line3, n_name AS city, {_state_case('c_custkey')} AS state,
          CAST(58000 + n_nationkey AS STRING) AS postal_code
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
        UNION ALL SELECT -1 - s_suppkey, s_name, CASE WHEN s_acctbal < 3000 THEN '  ' ELSE 'Dock 4' END,
          CASE WHEN s_acctbal > 6000 THEN 'Rear' END, CASE WHEN s_acctbal < 0 THEN NULL ELSE n_name END, {_state_case('s_suppkey')},
          CAST(58000 + n_nationkey AS STRING)
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey""",
    "comment": """
        SELECT event_id AS oid, CASE WHEN event_type = 'signup' THEN user_id * 7 ELSE user_id END AS ref_oid,
          CASE WHEN event_type = 'signup' THEN 'CNTRCT' ELSE 'ACCT' END AS ref_type, 7 AS comttype_oid,
          event_type AS message_type, CASE WHEN event_type = 'error' THEN NULL ELSE props END AS text,
          ts - INTERVAL 9000 DAY AS create_datetime, 'user' || CAST(user_id AS STRING) AS orig_user_name,
          event_type AS last_change_operator, ts AS last_change_datetime
        FROM {events}""",
    "ach_bank": """
        SELECT c_custkey AS ach_bank_oid, c_mktsegment || ' BANK' AS bank_name, CAST(91300000 + c_nationkey AS STRING) AS dfi_identification_number,
          c_custkey AS entity_oid FROM {customer}""",
    "ach_bank_account": """
        SELECT c_custkey AS ach_bank_account_oid, c_custkey AS ach_bank_oid,
          CASE c_mktsegment WHEN 'MACHINERY' THEN '' WHEN 'BUILDING' THEN '12' WHEN 'HOUSEHOLD' THEN '1234'
               WHEN 'FURNITURE' THEN NULL ELSE CAST(c_custkey * 7919 + 10000 AS STRING) END AS account_number,
          CASE WHEN c_acctbal > 0 THEN 21 ELSE 22 END AS account_category_oid,
          CASE WHEN c_acctbal > 5000 THEN 23 ELSE 29 END AS account_type_oid, 1 AS active,
          c_mktsegment AS last_change_operator,
          CAST('1999-01-01 00:00:00' AS TIMESTAMP) + c_nationkey * INTERVAL '1' DAY AS last_change_datetime
        FROM {customer}""",
    "eft_bank": _values("eft_bank_oid, description", [(1, "First ATA Bank"), (2, "Plains Bank"), (3, None), (4, "River Bank")]),
    "eft_schedule": """
        SELECT o_orderkey AS eft_schedule_oid, o_orderkey AS contract_oid, o_custkey AS receiving_bank_account_oid,
          @PRIO AS originating_bank_oid, o_orderdate AS start_date, '1' AS frequency, @TOTAL AS amount,
          CAST(@PRIO * 12 AS BIGINT) AS total_payments, CAST(@PRIO AS BIGINT) AS payments_processed,
          o_orderstatus AS last_change_operator, o_orderdate + INTERVAL 20 DAY AS last_change_datetime
        FROM {orders} WHERE o_orderpriority <> '3-MEDIUM' """,
    "contract_eft": """
        SELECT o_orderkey AS contract_eft_oid, o_orderkey AS contract_oid, o_custkey AS ach_bank_account_oid,
          o_orderdate AS start_date, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 400 DAY END AS end_date,
          CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 60 DAY END AS resume_date,
          o_orderstatus AS last_change_operator, o_orderdate + INTERVAL 15 DAY AS last_change_datetime
        FROM {orders} WHERE o_totalprice > 40000""",
    "contract_equipment": """
        SELECT @KEY AS contract_equipment_oid, l_orderkey AS contract_oid, @KEY AS equipment_oid,
          MIN(-1 - l_suppkey) AS bill_to_location_oid, CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS is_primary_for_pricing,
          CASE WHEN @MINFLAG = 'A' THEN 'driver' END AS driver_operator, @MAXFLAG AS last_change_operator,
          MAX(l_shipdate) AS last_change_datetime
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "equipment_id": """
        SELECT @KEY AS equipment_oid, 'SN' || CAST(MIN(l_partkey) AS STRING) AS serial_number FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "contract_item": """
        SELECT DISTINCT @KEY AS contract_item_oid, @KEY AS contract_equipment_oid,
          CASE WHEN l_linenumber = 7 THEN 9 ELSE 1 END AS contract_item_type_oid FROM {lineitem}""",
    "contract_disposed_asset": """
        SELECT @KEY AS contract_item_oid, l_orderkey AS contract_oid,
          CASE l_linenumber WHEN 1 THEN 'Sale' WHEN 2 THEN 'Inventory' WHEN 3 THEN 'Abandon' WHEN 4 THEN 'Trade' END AS disposal_type,
          CAST(SUM(@PRICE) AS DECIMAL(18,2)) AS disposal_amount, MAX(l_shipdate) AS bill_through_date, @KEY AS invoice_detail_oid
        FROM {lineitem} WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY l_orderkey, l_linenumber""",
    "equipment_location_history": """
        SELECT @KEY AS equipment_oid, -1 - l_suppkey AS location_oid, l_shipdate AS start_date FROM {lineitem}""",
    "contract_rewrite": """
        SELECT o_orderkey AS contract_rewrite_oid, o_orderkey AS contract_oid, 20 AS type_oid,
          CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 30 + @PRIO END AS reason_code_oid FROM {orders} WHERE o_orderstatus <> 'P'
        UNION ALL SELECT -1 - o_orderkey, o_orderkey, 20, 30 + @PRIO FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' """,
    "amort_schedule": """
        SELECT o_orderkey AS schedule_oid, o_orderkey AS ref_oid, CASE WHEN o_orderpriority = '2-HIGH' THEN 2 ELSE 1 END AS ref_type,
          o_orderdate AS last_change_datetime FROM {orders}""",
    "amort_line_item": """
        SELECT @KEY * 3 + @FLAG AS line_item_oid, l_orderkey AS schedule_oid, MIN(l_shipdate) + INTERVAL 10 HOUR AS event_date,
          'Event ' || CAST(l_linenumber AS STRING) AS note, CASE WHEN @MINSTATUS = 'O' THEN 1 ELSE 0 END AS is_loan,
          CASE WHEN @MINSTATUS = 'F' THEN 1 ELSE 0 END AS is_payment, CAST(SUM(@PRICE) AS DECIMAL(18,2)) AS event_amount,
          CAST(MAX(l_tax) AS DECIMAL(18,8)) AS new_rate, CAST(MAX(@TAX) AS DECIMAL(18,2)) AS interest_accrued,
          CAST(SUM(@PRICE) - MAX(@TAX) AS DECIMAL(18,2)) AS principal, CAST(MAX(@PRICE) AS DECIMAL(18,2)) AS balance,
          @MAXFLAG AS last_change_operator, MAX(l_shipdate) AS last_change_datetime
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber, l_returnflag""",
    "tax_detail_finalized": """
        SELECT l_orderkey AS contract_oid, @KEY AS contract_item_oid, @KEY AS parent_invoice_detail_oid,
          CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 9 ELSE 2 END AS contract_item_type_oid, l_partkey AS tax_product_oid,
          40 + l_linenumber AS tax_jurisdiction_oid, CASE WHEN l_tax > 0 THEN 45 ELSE 46 END AS applied_taxability_oid,
          CASE WHEN l_discount > 0.05 THEN 47 ELSE 48 END AS applied_tax_payment_type_oid, @PRICE AS taxable_amount, CAST(l_tax AS DECIMAL(18,8)) AS tax_rate,
          @TAX AS tax_amount, @TAX AS applied_tax_amount, l_shipdate AS payment_date, l_suppkey AS tax_code_oid
        FROM {lineitem}""",
    "tax_product": "SELECT p_partkey AS tax_product_oid, p_type AS description FROM {part} WHERE p_size > 5",
    "tax_code": """
        SELECT s_suppkey AS tax_code_oid, CAST(s_suppkey AS STRING) AS code, s_name AS description, s_nationkey AS state_oid,
          CASE WHEN s_acctbal > 5000 THEN 41 ELSE 42 END AS jurisdiction_oid, CASE WHEN s_acctbal > 0 THEN 43 ELSE 49 END AS administration_oid
        FROM {supplier}""",
    "tax_rate": """
        SELECT s_suppkey AS tax_code_oid, 'Sales' AS tax_type, 'State rate' AS description, CAST(0.05 AS DECIMAL(18,8)) AS tax_rate,
          CAST(0 AS DECIMAL(18,2)) AS min_taxable_amount, CAST(s_acctbal AS DECIMAL(18,2)) AS max_taxable_amount FROM {supplier}
        UNION ALL SELECT s_suppkey, 'Use', 'Use rate', CAST(0.01 AS DECIMAL(18,8)), CAST(0 AS DECIMAL(18,2)), NULL FROM {supplier} WHERE s_acctbal > 0""",
    "tax_exception": """
        SELECT o_orderkey AS tax_exception_oid, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS inactive_date FROM {orders}""",
    "tax_exception_asset": """
        SELECT DISTINCT l_orderkey AS tax_exception_oid, @KEY AS contract_item_oid FROM {lineitem} WHERE l_returnflag = 'R' """,
    "tax_exception_detail": """
        SELECT o_orderkey AS tax_exception_oid, CAST(o_custkey AS BIGINT) AS tax_code_oid, 41 AS jurisdiction_oid, 46 AS taxability_oid,
          CAST(@PRIO * 0.01 AS DECIMAL(18,8)) AS rate_override, CAST(NULL AS DECIMAL(18,8)) AS rate_adjustment FROM {orders}""",
    "state": "SELECT n_nationkey AS oid, n_name AS name FROM {nation} WHERE n_nationkey % 5 <> 4",
}


def view_sql(name: str) -> str:
    """The view text with the shorthands expanded; star tables stay as ``{name}``."""
    text = STAR_VIEWS[name]
    for macro, body in _MACROS.items():
        text = text.replace(macro, body)
    return text.strip()


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One star table with its declared schema (no inference job)."""
    return spark.read.schema(STAR_DDL[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class StarCatalog(TableCatalog):
    """A ``TableCatalog`` whose lease tables are views over the star tables in ``root``."""

    def star(self, name: str) -> DataFrame:
        key = f"star.{name}"
        if key not in self._tables:
            self._tables[key] = star_table(self.spark, self.root, name)
        return self._tables[key]

    def _declared(self, name: str) -> DataFrame:
        if name in self.overrides or name not in STAR_VIEWS:
            return super()._declared(name)
        text = view_sql(name)
        cols = ", ".join(f"CAST({c} AS {kind}) AS {c}" for c, kind in columns_of(name))
        used = {t: self.star(t) for t in STAR_DDL if f"{{{t}}}" in text}
        return self.spark.sql(f"SELECT {cols} FROM ({text}) AS view", **used)


def missing_views() -> set[str]:
    """Lease tables without a star view (none expected)."""
    return set(LEASE_DDL) - set(STAR_VIEWS)
