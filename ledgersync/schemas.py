"""Column contracts of the lease tables (library names, snake_case).

Times are zone-less (``timestamp_ntz``), as the ledger's date-times are; money is
``decimal(18,2)``, rates ``decimal(18,8)``, flags ``int`` 0/1 and keys ``bigint``.
"""

from __future__ import annotations

import re

_AUDIT = "last_change_operator string, last_change_datetime timestamp_ntz"

LEASE_DDL: dict[str, str] = {
    "contract": "contract_oid bigint, contract_id string, entity_oid bigint, company_oid bigint, is_booked int,"
    " is_terminated int, termination_date timestamp_ntz, bill_to_location_oid bigint, tax_location_oid bigint,"
    " transaction_code_oid bigint, invoice_code_oid bigint, invoice_lead_days_oid bigint,"
    " cash_application_code_oid bigint, tax_treatment string, implicit_rate decimal(18,8), is_suspend_invoice int,"
    f" is_non_accrual int, non_accrual_effective_date timestamp_ntz, {_AUDIT}",
    "contract_term": "contract_term_oid bigint, contract_oid bigint, start_date timestamp_ntz,"
    " maturity_date timestamp_ntz, internal_yield_rate decimal(18,8)",
    "general_ledger": "general_ledger_oid bigint, general_ledger_account_id_oid bigint,"
    " general_ledger_reference_oid bigint, account_id string, process_oid bigint, journal_number bigint,"
    " post_date timestamp_ntz, debit decimal(18,2), credit decimal(18,2)",
    "general_ledger_account_id": "general_ledger_account_id_oid bigint, contract_oid bigint, gl_accounts_oid bigint",
    "gl_accounts": "gl_accounts_oid bigint, account_title string",
    "general_ledger_reference": "general_ledger_reference_oid bigint, invoice_detail_oid bigint, company_oid bigint",
    "invoice_header": "invoice_header_oid bigint, contract_oid bigint, invoice_date timestamp_ntz,"
    f" due_date timestamp_ntz, is_posted int, {_AUDIT}",
    "invoice_detail": "invoice_detail_oid bigint, invoice_header_oid bigint, contract_oid bigint,"
    " contract_item_oid bigint, transaction_code_oid bigint, open_closed_oid bigint, location_oid bigint,"
    " original_due_amount decimal(18,2), current_due_amount decimal(18,2), due_date timestamp_ntz, is_paid int,"
    f" {_AUDIT}",
    "invoice_payment_history": "invoice_detail_oid bigint, applied_amount decimal(18,2),"
    " applied_date timestamp_ntz, post_date timestamp_ntz",
    "payment": "payment_oid bigint, contract_oid bigint, reference_number string, payment_method_oid bigint,"
    " amount decimal(18,2), post_date timestamp_ntz, effective_date timestamp_ntz, is_posted int, is_returned int,"
    f" {_AUDIT}",
    "cash_receipt_header": "cash_receipt_header_oid bigint, payment_oid bigint, description string",
    "cash_receipt_billable": "cash_receipt_billable_oid bigint, cash_receipt_header_oid bigint",
    "cash_receipt_detail": "cash_receipt_detail_oid bigint, cash_receipt_billable_oid bigint,"
    f" invoice_detail_oid bigint, applied_amount decimal(18,2), {_AUDIT}",
    "payment_stream": "payment_stream_oid bigint, contract_oid bigint, contract_term_oid bigint,"
    " schedule_definition_oid bigint, start_date timestamp_ntz, occurrences bigint, frequency string,"
    f" is_invoiced int, {_AUDIT}",
    "payment_stream_contract_item": "payment_stream_contract_item_oid bigint, payment_stream_oid bigint,"
    " contract_item_oid bigint, amount decimal(18,2), on_stream_tax_amount decimal(18,2), is_terminated int,"
    " last_change_datetime timestamp_ntz",
    "recurring_billable": "recurring_billable_oid bigint, contract_oid bigint, schedule_definition_oid bigint,"
    " transaction_code_oid bigint, description string, is_following_rent int, is_combined_with_rent int,"
    f" is_process_as_eft int, is_bill_after_termination int, {_AUDIT}",
    "transaction_code": "transaction_code_oid bigint, description string, invoice_description string",
    "invoice_code": "invoice_code_oid bigint, description string",
    "invoice_lead_days": "invoice_lead_days_oid bigint, description string",
    "cash_application_code": "cash_application_code_oid bigint, description string",
    "lti_values": "oid bigint, table_key string, data_value string, descr string",
    "generic_field": "oid bigint, descr string",
    "generic_value": "genf_oid bigint, ref_oid bigint, field_value string",
    "entity": "oid bigint, name string, legal_name string, alt_name string, fname string, mname string, lname string,"
    " suffix string, bus_or_ind string, email_addr string, collector_oid bigint,"
    f" permanent_collection_assignment_flag int, {_AUDIT}",
    "child_entity": "ref_oid bigint, entt_oid bigint, role_oid bigint, role_type string",
    "role": "oid bigint, descr string",
    "phone": f"oid bigint, entt_oid bigint, phone_type string, phone_num string, extension string, is_primary int, {_AUDIT}",
    "location": "oid bigint, addr_line1 string, addr_line2 string, addr_line3 string, city string, state string,"
    " postal_code string",
    "comment": "oid bigint, ref_oid bigint, ref_type string, comttype_oid bigint, message_type string, text string,"
    f" create_datetime timestamp_ntz, orig_user_name string, {_AUDIT}",
    "ach_bank": "ach_bank_oid bigint, bank_name string, dfi_identification_number string, entity_oid bigint",
    "ach_bank_account": "ach_bank_account_oid bigint, ach_bank_oid bigint, account_number string,"
    f" account_category_oid bigint, account_type_oid bigint, active int, {_AUDIT}",
    "eft_bank": "eft_bank_oid bigint, description string",
    "eft_schedule": "eft_schedule_oid bigint, contract_oid bigint, receiving_bank_account_oid bigint,"
    " originating_bank_oid bigint, start_date timestamp_ntz, frequency string, amount decimal(18,2),"
    f" total_payments bigint, payments_processed bigint, {_AUDIT}",
    "contract_eft": "contract_eft_oid bigint, contract_oid bigint, ach_bank_account_oid bigint,"
    f" start_date timestamp_ntz, end_date timestamp_ntz, resume_date timestamp_ntz, {_AUDIT}",
    "contract_equipment": "contract_equipment_oid bigint, contract_oid bigint, equipment_oid bigint,"
    f" bill_to_location_oid bigint, is_primary_for_pricing int, driver_operator string, {_AUDIT}",
    "equipment_id": "equipment_oid bigint, serial_number string",
    "contract_item": "contract_item_oid bigint, contract_equipment_oid bigint, contract_item_type_oid bigint",
    "contract_disposed_asset": "contract_item_oid bigint, contract_oid bigint, disposal_type string,"
    " disposal_amount decimal(18,2), bill_through_date timestamp_ntz, invoice_detail_oid bigint",
    "equipment_location_history": "equipment_oid bigint, location_oid bigint, start_date timestamp_ntz",
    "contract_rewrite": "contract_rewrite_oid bigint, contract_oid bigint, type_oid bigint, reason_code_oid bigint",
    "amort_schedule": "schedule_oid bigint, ref_oid bigint, ref_type int, last_change_datetime timestamp_ntz",
    "amort_line_item": "line_item_oid bigint, schedule_oid bigint, event_date timestamp_ntz, note string, is_loan int,"
    " is_payment int, event_amount decimal(18,2), new_rate decimal(18,8), interest_accrued decimal(18,2),"
    f" principal decimal(18,2), balance decimal(18,2), {_AUDIT}",
    "tax_detail_finalized": "contract_oid bigint, contract_item_oid bigint, parent_invoice_detail_oid bigint,"
    " contract_item_type_oid bigint, tax_product_oid bigint, tax_jurisdiction_oid bigint,"
    " applied_taxability_oid bigint, applied_tax_payment_type_oid bigint, taxable_amount decimal(18,2),"
    " tax_rate decimal(18,8), tax_amount decimal(18,2), applied_tax_amount decimal(18,2),"
    " payment_date timestamp_ntz, tax_code_oid bigint",
    "tax_product": "tax_product_oid bigint, description string",
    "tax_code": "tax_code_oid bigint, code string, description string, state_oid bigint, jurisdiction_oid bigint,"
    " administration_oid bigint",
    "tax_rate": "tax_code_oid bigint, tax_type string, description string, tax_rate decimal(18,8),"
    " min_taxable_amount decimal(18,2), max_taxable_amount decimal(18,2)",
    "tax_exception": "tax_exception_oid bigint, inactive_date timestamp_ntz",
    "tax_exception_asset": "tax_exception_oid bigint, contract_item_oid bigint",
    "tax_exception_detail": "tax_exception_oid bigint, tax_code_oid bigint, jurisdiction_oid bigint,"
    " taxability_oid bigint, rate_override decimal(18,8), rate_adjustment decimal(18,8)",
    "state": "oid bigint, name string",
}

STAR_DDL: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def parse_ddl(text: str) -> list[tuple[str, str]]:
    """(column, type) pairs of a flat column list, without a session."""
    return re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", text)


def columns_of(table: str, ddl: dict[str, str] = LEASE_DDL) -> list[tuple[str, str]]:
    """(column, type) pairs of a declared table."""
    return parse_ddl(ddl[table])
