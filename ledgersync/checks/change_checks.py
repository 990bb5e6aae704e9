"""Change propagation, maintained state, streams and stored copies, each against an independent SQL statement."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.checks.harness import AS_OF, END, MIDDLE, PREV_AS_OF, START, Registry
from ledgersync.checks.operator_checks import operators
from ledgersync.checks.plan_checks import _ACC_SCHEMA, _DEL_SCHEMA, _DELIVERED, _DIFFERS, _STORED, _TOTALS_SCHEMA, WINDOW, _stored, _win, accounting_sql, delinquency_sql, plans
from ledgersync.operators import aggregates as G
from ledgersync.operators import sync as R
from ledgersync.operators.bitmaps import member_split_bitmap
from ledgersync.operators.digests import snapshot_diff_stored, write_digests
from ledgersync.operators.ledger_sums import STATE_KEYS, LedgerSums, ledger_series
from ledgersync.operators.sets import union_arms
from ledgersync.plans import accounting as acc
from ledgersync.plans import contracts as contract_plans
from ledgersync.plans import delinquency, equipment, schedules, tax
from ledgersync.plans.notes import multi_deal_entities
from ledgersync.registry import OBJECTS, ObjectSpec
from ledgersync.session import scratch_path, stored
from ledgersync.sources.pull import pull_changes, watermark
from ledgersync.sources.sink import write_quarantined
from ledgersync.sources.star import StarCatalog
from ledgersync.streaming.balances import current_balances, empty_balances, stream_balances
from ledgersync.streaming.upsert import change_stream, empty_target, stream_upsert

changes = Registry()
add = changes.add
MID_MONTH = "1998-10-15 00:00:00"
_SCHEMA = {name: ", ".join(f"{c} {t}" for c, t in q.schema) for name, q in {**plans.items, **operators.items}.items()}
_FULL = {name: q.sql for name, q in {**plans.items, **operators.items}.items()}

# --- affected keys ------------------------------------------------------------------------

_IN = lambda c: _win(c)
_SCHEDULES = f"""SELECT schedule_definition_oid FROM lease_recurring_billable WHERE {_IN('last_change_datetime')}
  UNION SELECT schedule_definition_oid FROM lease_payment_stream WHERE {_IN('last_change_datetime')}
  UNION SELECT p.schedule_definition_oid FROM lease_payment_stream AS p JOIN lease_payment_stream_contract_item AS i
    ON i.payment_stream_oid = p.payment_stream_oid WHERE {_IN('i.last_change_datetime')}
  UNION SELECT r.schedule_definition_oid FROM lease_recurring_billable AS r JOIN lease_contract AS c ON c.contract_oid = r.contract_oid
    WHERE {_IN('c.last_change_datetime')}"""
add(
    "p09_scheduled_billables_changes",
    _SCHEMA["p09_scheduled_billables"],
    lambda c: schedules.scheduled_billables_changes(c, WINDOW),
    f"SELECT * FROM ({_FULL['p09_scheduled_billables']}) AS q WHERE schedule_definition_oid IN ({_SCHEDULES})",
)
_TERMS = f"""SELECT contract_term_oid FROM lease_payment_stream WHERE {_IN('last_change_datetime')}
  UNION SELECT t.contract_term_oid FROM lease_contract_term AS t JOIN lease_contract AS c ON c.contract_oid = t.contract_oid
    WHERE {_IN('c.last_change_datetime')}"""
add(
    "p10_total_payments_changes",
    _TOTALS_SCHEMA,
    lambda c: schedules.total_payments_changes(c, WINDOW),
    f"""SELECT * FROM ({_FULL['p10_total_payments']}) AS q WHERE contract_oid IN (
          SELECT contract_oid FROM lease_contract_term WHERE contract_term_oid IN ({_TERMS}))""",
)
_ITEMS = f"""SELECT contract_item_oid FROM lease_payment_stream_contract_item WHERE {_IN('last_change_datetime')}
  UNION SELECT d.contract_item_oid FROM lease_contract_disposed_asset AS d JOIN lease_invoice_detail AS i
    ON i.invoice_detail_oid = d.invoice_detail_oid WHERE {_IN('i.last_change_datetime')}
  UNION SELECT d.contract_item_oid FROM lease_contract_disposed_asset AS d JOIN lease_invoice_payment_history AS h
    ON h.invoice_detail_oid = d.invoice_detail_oid WHERE {_IN('h.post_date')}"""
_EQUIPMENT = f"""SELECT equipment_oid FROM lease_contract_equipment WHERE {_IN('last_change_datetime')}
  UNION SELECT e.equipment_oid FROM lease_contract_equipment AS e JOIN lease_contract AS c ON c.contract_oid = e.contract_oid
    WHERE {_IN('c.last_change_datetime')}
  UNION SELECT equipment_oid FROM lease_equipment_location_history WHERE {_IN('start_date')}
  UNION SELECT e.equipment_oid FROM lease_contract_equipment AS e JOIN lease_contract_item AS m
    ON m.contract_equipment_oid = e.contract_equipment_oid WHERE m.contract_item_oid IN ({_ITEMS})"""
add(
    "p13_equipment_changes",
    _SCHEMA["p13_equipment"],
    lambda c: equipment.equipment_changes(c, WINDOW),
    f"SELECT * FROM ({_FULL['p13_equipment']}) AS q WHERE equipment_oid IN ({_EQUIPMENT})",
)

# --- older and optional forms -------------------------------------------------------------


def _billables_copy(c: StarCatalog) -> DataFrame:
    """A stored copy in which some schedules are missing and some measures differ or are NULL."""
    key, full = F.col("schedule_definition_oid"), schedules.scheduled_billables(c)
    stale = {
        "total_due": F.when(key % 7 == 0, F.col("total_due") + 1).otherwise(F.col("total_due")),
        "is_process_as_eft": F.when(key % 11 == 0, 1 - F.col("is_process_as_eft")).otherwise(F.col("is_process_as_eft")),
        "next_payment_amount": F.when(key % 13 != 0, F.col("next_payment_amount")),
    }
    return full.filter(key % 5 != 0).withColumns(stale)


add(
    "p09_billables_against_copy",
    _SCHEMA["p09_scheduled_billables"],
    lambda c: schedules.scheduled_billables(c, previous=_billables_copy(c)),
    f"""SELECT * FROM ({_FULL['p09_scheduled_billables']}) AS q WHERE schedule_definition_oid % 5 <> 0
          AND ((schedule_definition_oid % 7 = 0 AND total_due IS NOT NULL) OR schedule_definition_oid % 11 = 0)""",
)
add(
    "p09_billables_all_contracts",
    _SCHEMA["p09_scheduled_billables"],
    lambda c: schedules.scheduled_billables(c, active_only=False),
    _FULL["p09_scheduled_billables"]
    .replace("WHERE c.is_terminated = 0 AND ", "WHERE ")
    .replace("CASE WHEN occ.uninv >= 1 THEN", "CASE WHEN occ.uninv >= 1 AND c.is_terminated = 0 THEN")
    .replace("AS start_date, occ.next_date,", "AS start_date, CASE WHEN c.is_terminated = 0 THEN occ.next_date END AS next_date,"),
)
_DAY = "LPAD(CAST(DAY(u.hi) AS VARCHAR), 2, '0')"
add(
    "p10_total_payments_earlier",
    _TOTALS_SCHEMA,
    lambda c: schedules.total_payments(c, as_of=AS_OF),
    _FULL["p10_total_payments"].replace(
        "u.hi AS next_payment",
        f"""CASE WHEN u.hi > TIMESTAMP '{AS_OF}' THEN CAST(i.lo AS DATE)
          WHEN DAY(u.hi) > 1 AND MONTH(u.hi) = 12 THEN CAST(TRY_CAST('2001-01-' || {_DAY} AS DATE) + INTERVAL 1 MONTH AS DATE)
          WHEN DAY(u.hi) > 1 THEN TRY_CAST('2000-01-' || {_DAY} AS DATE) END AS next_payment""",
    ),
)
add("p18_tax_code_values", "table_key string, oid bigint, data_value string", tax.tax_code_values, "SELECT table_key, oid, data_value FROM lease_lti_values WHERE table_key LIKE '%Tax%'")
add(
    "p20_delinquency_options",
    _DEL_SCHEMA,
    lambda c: delinquency.delinquency(c, AS_OF, oldest="min", returned_only=True),
    delinquency_sql(AS_OF)
    .replace("COUNT(is_returned) AS", "COUNT(CASE WHEN is_returned = 1 THEN 1 END) AS")
    .replace("MAX(due_date) FILTER (WHERE code IN (1, 35)) AS oldest_rent_due", "MIN(due_date) FILTER (WHERE code IN (1, 35)) AS oldest_rent_due, MAX(due_date) FILTER (WHERE code IN (1, 35)) AS latest_rent")
    .replace("WHEN due.oldest_rent_due >= TIMESTAMP", "WHEN due.latest_rent >= TIMESTAMP")
    .replace("DATE_DIFF('day', due.oldest_rent_due,", "DATE_DIFF('day', due.latest_rent,"),
)
_NI = ("ni_at_termination", "dpd_at_termination", "payments_made_at_termination", "balance_remaining_at_termination")
add(
    "p01_net_investments",
    "contract_oid bigint, opportunity string, net_investment double, dpd bigint, ni_at_termination double, dpd_at_termination bigint,"
    " payments_made_at_termination double, balance_remaining_at_termination double",
    lambda c: acc.net_investments(c, AS_OF),
    f"SELECT contract_oid, opportunity, net_investment, dpd, {', '.join(_NI)} FROM ({accounting_sql(AS_OF)}) AS q",
)
_BALANCES = "gross_receivable original_gross_receivable balance_remaining unearned_finance residual deferred_residual deferred_expense security_deposit".split()
_BALANCE_SCHEMA = "contract_oid bigint, " + ", ".join(f"{b} double" for b in _BALANCES)
add(
    "p01_balances",
    f"{_BALANCE_SCHEMA}, opportunity string, payments_made double",
    lambda c: acc.balances(c, AS_OF),
    f"SELECT contract_oid, opportunity, payments_made, {', '.join(_BALANCES)} FROM ({accounting_sql(AS_OF)}) AS q",
)


def _crm_folder(c: StarCatalog) -> StarCatalog:
    """A catalog whose downstream namespace is a folder: contracts, and accounting rows split in two halves per contract."""
    folder = scratch_path(c.spark, "crm")
    OBJECTS["contract"].to_crm(contract_plans.contracts(c)).write.parquet(f"{folder}/contract")
    copy = stored(_stored(c).select("contract_oid", *_BALANCES), "crm-balances")  # both halves are cut from it
    halves = union_arms(copy, copy.select("contract_oid", *[F.lit(None).cast("decimal(38,2)").alias(b) for b in _BALANCES]))
    halves.write.parquet(f"{folder}/accounting")
    return StarCatalog(c.spark, c.root, crm_root=folder)


add(
    "s02_crm_folder",
    _SCHEMA["s02_crm_snapshot"],
    lambda c: _crm_folder(c).read("crm.contract", "contract_oid bigint, opportunity string, implicit_rate decimal(18,8), is_terminated int"),
    _FULL["s02_crm_snapshot"],
)


def _against_totals(c: StarCatalog) -> DataFrame:
    crm = _crm_folder(c).read("crm.accounting", ", ".join(["contract_oid bigint", *[f"{b} decimal(38,2)" for b in _BALANCES]]))
    return acc.accounting(c, AS_OF, acc.stored_totals(crm))


_TOTALS = ", ".join(f"SUM(COALESCE({b}, 0)) AS {b}" for b in _BALANCES)
add(
    "p01_changes_against_totals",
    _ACC_SCHEMA,
    _against_totals,
    f"""{_DELIVERED} FROM (SELECT n.* FROM ({accounting_sql(AS_OF)}) AS n JOIN (
          SELECT *, gross_receivable - balance_remaining AS payments_made FROM (SELECT contract_oid, {_TOTALS} FROM ({_STORED}) AS s GROUP BY contract_oid) AS t) AS p
        ON p.contract_oid = n.contract_oid WHERE {_DIFFERS}) AS q""",
)

# --- maintained sums ----------------------------------------------------------------------


def _kept_sums(c: StarCatalog) -> LedgerSums:
    """Batches out of order, one of them added twice, one taken back and added again, folded in between."""
    gl = c.read("general_ledger")
    third = lambda k: gl.filter(F.col("journal_number") % 3 == k)
    kept = LedgerSums(c.spark, scratch_path(c.spark, "ledger-sums"))
    kept.add(third(2), "late")
    kept.add(third(0), "first")
    kept.fold()
    kept.add(third(1), "second")
    kept.add(third(1), "second")
    kept.add(third(0), "first")  # folded already
    kept.add(third(0), "take back", sign=-1)
    kept.fold()
    kept.add(third(0), "first again")
    return kept


add(
    "g02_maintained_sums",
    "general_ledger_account_id_oid bigint, account_id string, process_oid bigint, post_month date, amount double, ledger_rows bigint",
    lambda c: _kept_sums(c).sums(),
    f"""SELECT {', '.join(STATE_KEYS[:3])}, DATE_TRUNC('month', post_date) AS post_month, SUM(COALESCE(debit, 0) + COALESCE(credit, 0)) AS amount,
          COUNT(*) AS ledger_rows FROM lease_general_ledger GROUP BY ALL""",
)
add(
    "p01_from_maintained_sums",
    _ACC_SCHEMA,
    lambda c: acc.accounting(c, MID_MONTH, sums=_kept_sums(c).sums()),
    f"{_DELIVERED} FROM ({accounting_sql(MID_MONTH)}) AS q",
)
_DATES = ["1997-03-31 00:00:00", MID_MONTH, "1998-10-16 00:00:00", PREV_AS_OF, AS_OF]
add(
    "g02_balance_series",
    f"as_of ts, {_BALANCE_SCHEMA}",
    lambda c: ledger_series(c.read("general_ledger"), c.read("general_ledger_account_id"), _DATES),
    " UNION ALL ".join(f"SELECT TIMESTAMP '{d}' AS as_of, * FROM ({_FULL['g02_ledger_snapshot'].replace(AS_OF, d)}) AS s" for d in _DATES),
)
add(
    "p01_balance_series",
    f"as_of ts, {_BALANCE_SCHEMA}",
    lambda c: acc.balance_series(c, _DATES[:2]),
    " UNION ALL ".join(
        f"""SELECT TIMESTAMP '{d}' AS as_of, s.* FROM ({_FULL['g02_ledger_snapshot'].replace(AS_OF, d)}) AS s
            JOIN lease_contract AS k ON k.contract_oid = s.contract_oid AND k.is_booked = 1 AND k.company_oid = 1"""
        for d in _DATES[:2]
    ),
)

# --- streams ------------------------------------------------------------------------------

_LEDGER_DDL = "general_ledger_account_id_oid bigint, account_id string, process_oid bigint, debit decimal(18,2), credit decimal(18,2)"


def _streamed_balances(c: StarCatalog) -> DataFrame:
    """The ledger in folders of one micro-batch each, with a reversal, over two runs of the stream."""
    columns = [p.split()[0] for p in _LEDGER_DDL.split(", ")]
    account_ids = stored(c.read("general_ledger_account_id"), "stream-accounts")  # a table, as it is on a ledger: every micro-batch reads it
    gl, folder = c.read("general_ledger"), scratch_path(c.spark, "stream-ledger")
    target, checkpoint = scratch_path(c.spark, "stream-balances"), scratch_path(c.spark, "stream-checkpoint")
    buckets = G.snapshot_buckets()
    empty_balances(c.spark, target, buckets, 8)
    part = lambda k: gl.filter(F.col("journal_number") % 3 == k).select(*columns)
    back = part(0).withColumns({"debit": -F.col("debit"), "credit": -F.col("credit")})
    for run in ([part(0), part(1), back], [part(2), part(0)]):
        for k, rows in enumerate(run):
            rows.write.parquet(f"{folder}/f{len(run)}{k}")
        files = len(c.spark.read.schema(_LEDGER_DDL).parquet(f"{folder}/f{len(run)}0").inputFiles())
        stream = change_stream(c.spark, f"{folder}/*", _LEDGER_DDL, files_per_trigger=files)
        stream_balances(stream, account_ids, buckets, target, checkpoint).awaitTermination()
    return current_balances(c.spark, target, buckets)


add(
    "t01_stream_balances",
    _BALANCE_SCHEMA,
    _streamed_balances,
    _FULL["g02_ledger_snapshot"]
    .replace(f"WHERE post_date <= TIMESTAMP '{AS_OF}'", "")
    .replace("COALESCE(SUM(amt) FILTER (WHERE account_id = '01-10089' AND process_oid IN (20119, 20126, 20127, 20140)), 0)",
             "SUM(amt) FILTER (WHERE account_id = '01-10089' AND process_oid IN (20119, 20126, 20127, 20140))"),
)

_EVENT = ObjectSpec("user_state", "user_id", {"user_id": "User__c", "event_id": "Event__c", "event_type": "Type__c", "ts": "Changed__c"})
_EVENT_DDL = "user_id bigint, event_id bigint, event_type string, ts timestamp_ntz"


def _keyless_stream(c: StarCatalog) -> DataFrame:
    """Events of which some have no user: merged by user, the others kept each; two runs with a merge in between."""
    folder, target, checkpoint = (scratch_path(c.spark, n) for n in ("stream-events", "stream-target", "stream-checkpoint"))
    events = c.star("events").withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id"))).select(*_EVENT.columns)
    empty_target(c.spark, target, _EVENT_DDL, "user_id", 4)
    for turn in range(3):
        events.filter(F.col("event_id") % 3 == turn).coalesce(1).write.parquet(f"{folder}/f{turn}")
        stream = change_stream(c.spark, f"{folder}/*", _EVENT_DDL)
        stream_upsert(stream, _EVENT, "ts", target, checkpoint, ["event_id"], on_null_key="insert").awaitTermination()
        if turn < 2:
            R.compact(c.spark, target, _EVENT, ["ts", "event_id"])
    return R.keyed_state(c.spark, target, _EVENT, _EVENT_DDL, ["ts", "event_id"])


add(
    "t01_stream_keyless",
    "user_id bigint, event_id bigint, event_type string, ts ts",
    _keyless_stream,
    """SELECT user_id, event_id, event_type, ts FROM (SELECT * FROM events WHERE event_type <> 'error'
         QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) AS k
       UNION ALL SELECT NULL, event_id, event_type, ts FROM events WHERE event_type = 'error'""",
)

# --- stored copies, key lists, batches, watermarks ----------------------------------------


def _digest_diff(c: StarCatalog) -> DataFrame:
    """A copy in 64 buckets; one contract in 500 has changed since."""
    gl, ids = c.read("general_ledger"), c.read("general_ledger_account_id")
    copy = G.ledger_snapshot(gl, ids, PREV_AS_OF).select("contract_oid", "balance_remaining", "residual")
    path = scratch_path(c.spark, "digest-copy")
    R.write_keyed(copy, path, "contract_oid", 64)
    measures = ["balance_remaining", ("balance_remaining", "residual")]
    write_digests(c.spark, path, "contract_oid", measures)
    moved = F.when(F.col("contract_oid") % 500 == 1, F.col("balance_remaining") + 1).otherwise(F.col("balance_remaining"))
    return snapshot_diff_stored(copy.withColumn("balance_remaining", moved), path, "contract_oid", measures)


add(
    "r02_digest_diff",
    "contract_oid bigint, change_status string",
    _digest_diff,
    f"""SELECT contract_oid, CASE WHEN contract_oid % 500 = 1 AND balance_remaining IS NOT NULL THEN 'Data Changed' ELSE 'No Changes' END AS change_status
        FROM ({_FULL['g02_ledger_snapshot'].replace(AS_OF, PREV_AS_OF)}) AS s""",
)


def _bitmap_split(c: StarCatalog) -> DataFrame:
    entities = c.read("entity").select("oid", "name")
    multi, single = member_split_bitmap(entities, "oid", multi_deal_entities(c.read("contract"), 10))
    return union_arms(multi.withColumn("route", F.lit("multi")), single.withColumn("route", F.lit("single")))


add("f06_key_bitmap", _SCHEMA["f06_key_list_split"], _bitmap_split, _FULL["f06_key_list_split"])


def _quarantined(c: StarCatalog) -> DataFrame:
    """Contracts of which some lost their key and some came twice."""
    key, rows = F.col("contract_oid"), contract_plans.contracts(c)
    bad = union_arms(rows.withColumn("contract_oid", F.when(key % 7 != 0, key)), rows.filter((key % 10 == 0) & (key % 7 != 0)))
    batch = write_quarantined(bad, "contract", "contract_oid", scratch_path(c.spark, "publish"), "b1")
    read = lambda p, reason: c.spark.read.parquet(p).select(F.col("ContractOID__c").alias("contract_oid"), reason, F.col("Opportunity__c").alias("opportunity"))
    both = union_arms(read(batch.accepted, F.lit(None).cast("string").alias("reason")), read(batch.rejected, F.col("reason")))
    return both.withColumns({"accepted": F.lit(batch.n_accepted), "rejected": F.lit(batch.n_rejected)})


_CONTRACT_ROWS = f"(SELECT contract_oid, opportunity FROM ({_FULL['s05_upsert_batch']}) AS q)"
_TAGGED = f"""SELECT CASE WHEN contract_oid % 7 <> 0 THEN contract_oid END AS contract_oid, opportunity,
    CASE WHEN contract_oid % 7 = 0 THEN 'no key' WHEN contract_oid % 10 = 0 THEN 'repeated key' END AS reason FROM {_CONTRACT_ROWS} AS a
  UNION ALL SELECT contract_oid, opportunity, 'repeated key' FROM {_CONTRACT_ROWS} AS b WHERE contract_oid % 10 = 0 AND contract_oid % 7 <> 0"""
add(
    "s05_quarantined_batch",
    "contract_oid bigint, opportunity string, reason string, accepted bigint, rejected bigint",
    _quarantined,
    f"SELECT *, COUNT(*) FILTER (WHERE reason IS NULL) OVER () AS accepted, COUNT(reason) OVER () AS rejected FROM ({_TAGGED}) AS t",
)

_PAY = ObjectSpec("payment_state", "payment_oid", {c: c for c in ("payment_oid", "amount", "operator", "changed")})
_PAY_DDL = "payment_oid bigint, amount decimal(18,2), operator string, changed timestamp_ntz"


def _pulled(c: StarCatalog) -> DataFrame:
    """Pulls up to three times, the second of which stopped before its watermark was stored; the last one is repeated."""
    rows = c.read("payment").select("payment_oid", "amount", F.col("last_change_operator").alias("operator"), F.col("last_change_datetime").alias("changed"))
    target, overlap = scratch_path(c.spark, "pulled"), timedelta(days=3)
    empty_target(c.spark, target, _PAY_DDL, "payment_oid", 4)
    pull_changes(rows, target, _PAY, "changed", START, overlap)
    stopped = R.incremental_pull(rows, "changed", watermark(c.spark, target), overlap, MIDDLE)
    R.append_changes(stopped.withColumn("operator", F.lit("old")).withColumn("changed", F.col("changed") - F.expr("INTERVAL 1 HOUR")), target, _PAY, "stopped", ["changed"])
    for _ in range(2):
        pull_changes(rows, target, _PAY, "changed", END, overlap)
    return R.keyed_state(c.spark, target, _PAY, _PAY_DDL, ["changed"])


add(
    "r07_stored_watermark",
    "payment_oid bigint, amount double, operator string, changed ts",
    _pulled,
    f"""SELECT payment_oid, amount, last_change_operator AS operator, last_change_datetime AS changed FROM lease_payment
        WHERE last_change_datetime <= TIMESTAMP '{END}'""",
)

__all__ = ["changes"]
