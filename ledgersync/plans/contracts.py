"""Contract attributes, collectors, customers and phones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.functions.clock import Window
from ledgersync.functions.predicates import changed_between, changed_between_any, in_codes, require
from ledgersync.functions.scalar import blank_when, composite_key, full_address, latest_of, prefix
from ledgersync.operators.joins import code_lookup, lookup, self_lookup, star_left
from ledgersync.plans.common import with_opportunity
from ledgersync.registry import OBJECTS
from ledgersync.sources.catalog import TableCatalog

# Fixed values of the party extract: the own company's entity and the roles left out.
OWN_ENTITY = 1
LEFT_OUT_ROLES = ("Collector", "Broker", "Contract Manager")
GUARANTOR = "Guarantor"


def collectors(cat: TableCatalog, window: Window | None = None) -> DataFrame:
    """Collector of each contract's customer; the window applies to the customer's change time."""
    people = self_lookup(cat.read("entity"), "collector_oid", "oid", {"name": "collector_name"})
    cols = ("collector_name", "permanent_collection_assignment_flag", "last_change_operator", "last_change_datetime")
    # A window is null-rejecting, so the outer join with the customer is then an inner one.
    people = changed_between(people, "last_change_datetime", window)
    contracts = cat.read("contract").select("contract_oid", "entity_oid")
    out = lookup(contracts, people, [("entity_oid", "oid")], {c: c for c in cols}, "inner" if window else "left")
    return with_opportunity(out, cat).select(*OBJECTS["collector"].columns)


def contracts(cat: TableCatalog, window: Window | None = None) -> DataFrame:
    """Contract attributes with their code texts."""
    c = changed_between(cat.read("contract"), "last_change_datetime", window)
    c = star_left(
        c.withColumnRenamed("tax_treatment", "tax_treatment_code"),
        [
            (cat.read("transaction_code"), "transaction_code_oid", {"description": "transaction_code"}),
            (cat.read("invoice_code"), "invoice_code_oid", {"description": "invoice_code"}),
            (cat.read("contract_term"), "contract_oid", {"internal_yield_rate": "internal_yield_rate"}),
            (cat.read("invoice_lead_days"), "invoice_lead_days_oid", {"description": "invoice_lead_days"}),
            (cat.read("cash_application_code"), "cash_application_code_oid", {"description": "cash_application"}),
        ],
    )
    c = code_lookup(c, cat.read("lti_values"), "tax_treatment_code", {"descr": "tax_treatment"}, "TAX_TREATMENT", "data_value")
    return with_opportunity(c, cat).select(*OBJECTS["contract"].columns)


def customers(cat: TableCatalog, window: Window | None = None, key_sep: str = "") -> DataFrame:
    """Parties of each contract with addresses and collector.

    The text key joins contract, entity and the first letter of the role without a
    separator unless ``key_sep`` is given.
    """
    entity, location = cat.read("entity"), cat.read("location")
    address = location.select(
        F.col("oid").alias("location_oid"),
        full_address("addr_line1", "addr_line2", "city", "state", "postal_code").alias("address"),
    )
    empty = F.lit(", ,  ")  # the text of an address without location: separators only

    def with_address(df: DataFrame, key: str, name: str) -> DataFrame:
        return lookup(df, address, [(key, "location_oid")], {"address": name}).withColumn(name, F.coalesce(name, empty))

    c = cat.read("contract").select(
        "contract_oid",
        "bill_to_location_oid",
        "tax_location_oid",
        F.col("last_change_datetime").alias("c_change"),
        F.col("last_change_operator").alias("c_operator"),
    )
    c = with_address(with_address(c, "bill_to_location_oid", "bill_to_location"), "tax_location_oid", "tax_location")
    priced = cat.read("contract_equipment").filter(F.col("is_primary_for_pricing") == 1)
    priced = with_address(
        priced.select("contract_oid", "bill_to_location_oid", "last_change_datetime", "last_change_operator"),
        "bill_to_location_oid",
        "equipment_bill_to_location",
    ).distinct()
    roles = cat.read("role").filter(in_codes("descr", LEFT_OUT_ROLES, negate=True))
    parties = lookup(
        cat.read("child_entity").filter(F.col("entt_oid") != OWN_ENTITY), roles, [("role_oid", "oid")], {"descr": "role_type_text"}, "inner"
    )
    people = self_lookup(entity, "collector_oid", "oid", {"name": "collector_name"})
    cols = (
        "name legal_name alt_name email_addr collector_oid collector_name permanent_collection_assignment_flag"
        " last_change_datetime last_change_operator"
    ).split()
    out = lookup(
        c,
        parties,
        [("contract_oid", "ref_oid")],
        {"entt_oid": "entity_oid", "role_type_text": "role_type"},
        "inner",
    )
    # The opportunity and the equipment's address follow while the rows lie by contract; the wide columns of the party come last.
    out = lookup(
        with_opportunity(out, cat, how="left"),
        priced,
        "contract_oid",
        {
            "equipment_bill_to_location": "equipment_bill_to_location",
            "last_change_datetime": "ce_change",
            "last_change_operator": "ce_operator",
        },
    )
    out = lookup(out, people, [("entity_oid", "oid")], {n: n for n in cols})
    out = changed_between_any(out, ["last_change_datetime", "c_change", "ce_change"], window)
    times = ["last_change_datetime", "c_change", "ce_change"]
    operators = ["last_change_operator", "c_operator", "ce_operator"]
    guarantor = F.col("role_type") == GUARANTOR
    out = out.select(
        composite_key("contract_oid", "entity_oid", prefix("role_type", 1), sep=key_sep).alias("unique_id"),
        "opportunity",
        "entity_oid",
        "role_type",
        "name",
        "legal_name",
        "alt_name",
        F.col("email_addr").alias("email_address"),
        "bill_to_location",
        "tax_location",
        "equipment_bill_to_location",
        blank_when(guarantor, "collector_oid").alias("collector_oid"),
        blank_when(guarantor, "collector_name").alias("collector_name"),
        blank_when(guarantor, "permanent_collection_assignment_flag").alias("permanent_collection_assignment_flag"),
        latest_of(times).alias("last_change_datetime"),
        latest_of(times, operators).alias("last_change_operator"),
    )
    return out.select(*OBJECTS["customer"].columns)


def phones(cat: TableCatalog, window: Window | None = None) -> DataFrame:
    """Phones of known entities."""
    ph = changed_between(require(cat.read("phone"), "oid"), "last_change_datetime", window)
    known = ph.join(cat.read("entity").select(F.col("oid").alias("entt_oid")), "entt_oid", "left_semi")
    return known.select(
        F.col("oid").alias("phone_oid"),
        F.col("entt_oid").alias("entity_oid"),
        "phone_type",
        F.col("phone_num").alias("phone_number"),
        "extension",
        F.col("is_primary").alias("primary_phone"),
        "last_change_operator",
        "last_change_datetime",
    ).distinct()
