"""The synchronised objects: key, columns and downstream field names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ObjectSpec:
    """How one object is merged and published.

    ``fields`` maps library columns to downstream fields in insert order.
    ``update`` lists the columns a matched row takes over (default: all but the
    key). ``defaults`` replaces NULLs again on write.
    """

    name: str
    key: str
    fields: Mapping[str, str]
    update: tuple[str, ...] | None = None
    defaults: Mapping[str, int] = field(default_factory=dict)
    changed: str | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.fields)

    @property
    def update_columns(self) -> tuple[str, ...]:
        return self.update if self.update is not None else tuple(c for c in self.fields if c != self.key)

    def to_crm(self, df: DataFrame) -> DataFrame:
        """Downstream field names, with the empty record id the upsert expects."""
        return df.select(F.lit(None).cast("string").alias("ID"), *[F.col(c).alias(n) for c, n in self.fields.items()])


def _fields(text: str) -> dict[str, str]:
    """Parse ``column Field`` pairs."""
    return dict(pair.split() for pair in text.strip().splitlines())


def _without(fields: Mapping[str, str], *cols: str) -> tuple[str, ...]:
    return tuple(c for c in fields if c not in cols)


# Field names the downstream system knows, in insert order.
_ACCOUNTING = _fields("""
contract_oid contractOID__c
opportunity Opportunity__c
gross_receivable Gross_Receivable__c
original_gross_receivable Original_Gross_Receivable__c
payments_made Payments_Made__c
balance_remaining Balance_Remaining__c
unearned_finance Unearned_Finance__c
residual Residual__c
deferred_residual Deferred_Residual__c
deferred_expense Deferred_Expense__c
security_deposit Security_Deposit__c
net_investment Net_Investment__c
dpd DPD__c
ni_at_termination NI_at_Termination__c
dpd_at_termination DPD_at_Termination__c
payments_made_at_termination Payments_Made_At_Termination__C
balance_remaining_at_termination Balance_Remaining_At_termination__C
""")
_COLLECTOR = _fields("""
contract_oid ContractOID__C
opportunity Opportunity__c
collector_name CollectorName__c
permanent_collection_assignment_flag PermanentCollectionAssignmentFlag__c
last_change_datetime LastChangeDateTime__c
last_change_operator LastChangeOperator__c
""")
_CONTRACT = _fields("""
contract_oid ContractOID__c
opportunity Opportunity__c
transaction_code TransactionCode__c
invoice_code InvoiceCode__c
is_suspend_invoice IsSuspendInvoice__c
implicit_rate ImplicitRate__c
internal_yield_rate InternalYieldRate__c
invoice_lead_days InvoiceLeadDays__c
tax_treatment TaxTreatment__c
cash_application CashApplication__C
is_non_accrual IsNonAccrual__c
non_accrual_effective_date NonAccrualEffectiveDate__c
is_terminated IsTerminated__c
termination_date TerminationDate__c
last_change_operator LastChangeOperator__c
last_change_datetime LastChangeDateTime__c
""")
_EFT_ALT = _fields("""
opportunity Opportunity__c
eft_schedule_oid EftScheduleOid__c
start_date StartDate__c
frequency Frequency__c
amount Amount__c
total_payments TotalPayments__c
payments_processed PaymentsProcessed__c
account_number AccountNumber__c
bank_name BankName__c
originating_bank OriginatingBank__c
last_change_datetime LastChangeDateTime__c
last_change_operator LastChangeOperator__c
""")
_EFT_ASSIGN = _fields("""
opportunity Opportunity__c
contract_eft_oid ContractEFTOid__c
account_number AccountNumber__c
bank_name BankName__c
start_date StartDate__c
end_date EndDate__c
resume_date ResumeDate__c
last_change_datetime LastChangeDateTime__c
last_change_operator LastChangeOperator__c
""")
_INVOICE = _fields("""
opportunity Opportunity__c
invoice_header_oid InvoiceHeaderOID__c
invoice_detail_oid InvoiceDetailOID__c
name Name
contract_item_oid ContractItemOid__c
payment_method_oid PaymentMethodOID__c
invoice_payment_method InvoicePaymentMethod__c
transaction_code TransactionCode__C
description Description__c
original_due_amount OriginalDueAmount__c
current_due_amount CurrentDueAmount__c
invoice_date InvoiceDate__C
due_date DueDate__c
is_paid IsPaid__C
last_change_operator LastChangeOperator__c
last_change_datetime LastChangeDatetime__c
""")
_NOTES = _fields("""
opportunity Opportunity__c
comment_oid CommentOID__c
entity_oid EntityOID__c
ref_type Ref_Type__c
message_type Message_Type__c
text Text__c
create_datetime Create_DateTime__c
orig_user_name Orig_User_Name__c
last_change_operator LastChangeOperator__c
last_change_datetime LastChangeDateTime__c
""")
_PAYMENT = _fields("""
opportunity Opportunity__c
payment_oid PaymentOid__c
reference_number ReferenceNumber__c
invoice_header_oid InvoiceHeaderOid__c
invoice_detail_oid InvoiceDetailOid__c
cash_receipt_detail_oid CashReceiptDetailOID__c
descr descr__c
applied_amount AppliedAmount__c
post_date PostDate__c
effective_date EffectiveDate__c
is_posted IsPosted__c
is_returned IsReturned__c
description Description__c
detail_last_change_operator CRDLastChangeOperator__c
detail_last_change_datetime CRDLastChangeDateTime__c
payment_last_change_datetime PaymentLastChangeDateTime__c
""")
_BILLABLES = _fields("""
opportunity Opportunity__c
recurring_billable_oid RecurringBillableOid__c
invoice_description Invoicedescription__c
description Description__c
schedule_definition_oid ScheduleDefinitionOID__C
is_following_rent IsFollowingRent__C
is_combined_with_rent IsCombinedWithRent__c
is_process_as_eft IsProcessAsEFT__c
is_bill_after_termination IsBillAftertermination__c
frequency Frequency__c
total_amount_due TotalAmountDue__c
total_tax_amount_due TotalTaxAmountDue__c
total_due TotalDue__c
invoiced_occurrences isInvoicedOccurrences__C
invoiced_total_amount InvoicedTotalAmount__c
uninvoiced_occurrences unInvoicedOccurrences__C
uninvoiced_total_amount UninvoicedTotalAmount__c
start_date StartDate__c
next_date nextDate__c
next_payment_amount NextPaymentAmount__c
next_payment_tax_amount NextPaymentTaxAmount__c
next_payment_total_amount NextPaymentTotalAmount__c
last_change_operator LastChangeOperator__c
last_change_datetime LastChangeDateTime__c
""")
_TOTALS = _fields("""
contract_oid ContractOID__c
opportunity Opportunity__c
total_scheduled_payments TtlSchPymts__c
invoiced_payments InvPymtsAmount__c
uninvoiced_payments UninvPymtsAmount__c
first_payment FirstPayment__c
next_payment NextPayment__c
maturity_date MaturityDate__c
last_change_datetime LastChangeDateTime__c
last_change_operator LastChangeOperator__c
""")
_CUSTOMER = _fields("""
unique_id UniqueID__C
opportunity Opportunity__c
entity_oid EntityOID__C
role_type RoleType__c
name Name__C
legal_name LegalName__c
alt_name AltName__c
email_address EmailAddress__c
bill_to_location BillToLocation__c
tax_location TaxLocation__c
equipment_bill_to_location CEBillToLocation__c
collector_oid CollectorOID__c
collector_name CollectorName__c
permanent_collection_assignment_flag PermanentCollectionAssignmentFlag__c
last_change_datetime LastChangeDateTime__c
last_change_operator LastChangeOperator__c
""")
_PHONE = _fields("""
phone_oid PhoneOID__c
entity_oid EntityOID__C
phone_type PhoneType__c
phone_number PhoneNumber__c
extension Extension__c
primary_phone PrimaryPhone__c
last_change_operator phLastchangeOperator__c
last_change_datetime phLastChangeDateTime__c
""")
_EQUIPMENT = _fields("""
opportunity Opportunity__c
equipment_oid EquipmentOID__c
contract_item_oid ContractItemOID__c
serial_number serialnumber__c
equipment_location EquipmentLocation__c
payment_amount PaymentAmount__C
payment_tax_amount PaymentTaxAmount__C
bill_through_date BillThroughDate__c
disposal_type DisposalType__c
disposal_amount DisposalAmount__c
sale_date SaleDate__C
post_date PostDate__c
applied_date AppliedDate__c
last_change_operator ceLastChangeOperator__c
last_change_datetime ceLastChangeDateTime__c
""")
_HEADER = _fields("""
opportunity Opportunity__c
invoice_header_oid InvoiceHeaderOID__c
last_change_operator IHLastChangeOperator__c
last_change_datetime IHLastChangeDatetime__c
""")
_PAYMENT_KEY = _fields("""
opportunity Opportunity__c
payment_oid PaymentOID__c
amount amount__c
last_change_operator PLastChangeOperator__c
last_change_datetime PLastChangeDatetime__c
""")
_AMORT = _fields("""
opportunity OpportunityID__c
line_item_oid LineItemOID__c
schedule_oid ScheduleOid__c
event_date Date__c
source Source__c
amount_financed AmountFinanced__c
rate Rate__c
payment Payment__c
interest Interest__c
principal Principal__c
balance Balance__c
last_change_operator LastChangeOperator__c
last_change_datetime LastChangeDateTime__c
""")

_ACCOUNTING_DEFAULTS = dict.fromkeys(
    (
        "unearned_finance", "residual", "deferred_residual", "security_deposit", "net_investment", "dpd",
        "ni_at_termination", "dpd_at_termination", "payments_made_at_termination", "balance_remaining_at_termination",
    ),
    0,
)

OBJECTS: dict[str, ObjectSpec] = {
    s.name: s
    for s in (
        ObjectSpec("accounting", "contract_oid", _ACCOUNTING, defaults=_ACCOUNTING_DEFAULTS),
        ObjectSpec("collector", "contract_oid", _COLLECTOR, changed="last_change_datetime"),
        ObjectSpec("contract", "contract_oid", _CONTRACT, changed="last_change_datetime"),
        ObjectSpec("eft_alt_schedule", "eft_schedule_oid", _EFT_ALT,
                   _without(_EFT_ALT, "eft_schedule_oid", "opportunity"), changed="last_change_datetime"),
        ObjectSpec("eft_assignment", "contract_eft_oid", _EFT_ASSIGN, changed="last_change_datetime"),
        ObjectSpec("invoice", "invoice_detail_oid", _INVOICE,
                   _without(_INVOICE, "invoice_detail_oid", "opportunity"), changed="last_change_datetime"),
        ObjectSpec("notes", "comment_oid", _NOTES, _without(_NOTES, "comment_oid", "opportunity"),
                   changed="last_change_datetime"),
        ObjectSpec("payment", "cash_receipt_detail_oid", _PAYMENT, changed="payment_last_change_datetime"),
        ObjectSpec("scheduled_billables", "schedule_definition_oid", _BILLABLES, changed="last_change_datetime"),
        ObjectSpec("total_payments", "contract_oid", _TOTALS, changed="last_change_datetime"),
        ObjectSpec("customer", "unique_id", _CUSTOMER, changed="last_change_datetime"),
        ObjectSpec("phone", "phone_oid", _PHONE, changed="last_change_datetime"),
        ObjectSpec("equipment", "equipment_oid", _EQUIPMENT, changed="last_change_datetime"),
        ObjectSpec("invoice_header", "invoice_header_oid", _HEADER, ("opportunity",), changed="last_change_datetime"),
        ObjectSpec("payment_key", "payment_oid", _PAYMENT_KEY, changed="last_change_datetime"),
        ObjectSpec("amortization", "line_item_oid", _AMORT, changed="last_change_datetime"),
    )
}

# The (object, external key) pairs pushed downstream, in push order.
PUBLISHED: tuple[tuple[str, str], ...] = (
    ("accounting", "contract_oid"),
    ("eft_alt_schedule", "eft_schedule_oid"),
    ("eft_assignment", "contract_eft_oid"),
    ("equipment", "equipment_oid"),
    ("invoice", "invoice_detail_oid"),
    ("notes", "comment_oid"),
    ("payment", "cash_receipt_detail_oid"),
    ("scheduled_billables", "schedule_definition_oid"),
    ("total_payments", "contract_oid"),
    ("phone", "phone_oid"),
    ("amortization", "line_item_oid"),
    ("collector", "contract_oid"),
    ("contract", "contract_oid"),
)
