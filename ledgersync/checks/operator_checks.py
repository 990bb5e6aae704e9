"""The operators one by one, each against an equivalent SQL statement."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.checks.harness import AS_OF, END, JOURNAL_MONTH, MIDDLE, NOTE_END, NOTE_START, PREV_AS_OF, START, Registry, merge_sql
from ledgersync.functions import predicates as P
from ledgersync.functions import scalar as X
from ledgersync.functions.clock import Window, ts, window_for
from ledgersync.operators import aggregates as G
from ledgersync.operators import joins as J
from ledgersync.operators import sync as R
from ledgersync.operators.sets import ordered, union_arms
from ledgersync.operators.windows import latest_per_key, number_lines
from ledgersync.plans import contracts as contract_plans
from ledgersync.plans import invoices as invoice_plans
from ledgersync.plans.notes import multi_deal_entities
from ledgersync.registry import OBJECTS, ObjectSpec
from ledgersync.session import scratch_path
from ledgersync.sources.inline import vendor_table
from ledgersync.sources.sink import write_upsert_batch
from ledgersync.sources.star import StarCatalog
from ledgersync.streaming.upsert import change_stream, empty_target, stream_upsert

operators = Registry()
add = operators.add
WINDOW = Window.of(START, END)
NOTE_WINDOW = Window.of(NOTE_START, NOTE_END)
TS = "TIMESTAMP '{}'".format
IN_WINDOW = f"BETWEEN {TS(START)} AND {TS(END)}"
OPP = "(SELECT DISTINCT ref_oid, COALESCE(field_value, 'NULL') AS opportunity FROM lease_generic_value WHERE genf_oid = 23)"
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

# --- sources and sinks --------------------------------------------------------------------

add(
    "s01_catalog_scan",
    "contract_oid bigint, contract_id string, is_booked int, implicit_rate double, last_change_datetime ts",
    lambda c: c.read("contract"),
    "SELECT * FROM lease_contract",
)


def _crm_catalog(c: StarCatalog) -> StarCatalog:
    """A catalog whose downstream namespace holds the contract object under its field names."""
    stored = OBJECTS["contract"].to_crm(contract_plans.contracts(c))
    return StarCatalog(c.spark, c.root, {"crm.contract": stored})


add(
    "s02_crm_snapshot",
    "contract_oid bigint, opportunity string, implicit_rate double, is_terminated int",
    lambda c: _crm_catalog(c).read(
        "crm.contract", "contract_oid bigint, opportunity string, implicit_rate decimal(18,8), is_terminated int"
    ),
    f"SELECT c.*, o.opportunity FROM lease_contract AS c JOIN {OPP} AS o ON o.ref_oid = c.contract_oid",
)


def _switched(c: StarCatalog) -> DataFrame:
    """The same query with one table taken from another environment."""
    other = c.read("contract").filter(F.col("is_terminated") == 0)
    test = StarCatalog(c.spark, c.root, {"contract": other})
    return test.read("contract").join(test.read("contract_term"), "contract_oid").withColumn("environment", F.lit("test"))


add(
    "s03_environment_switch",
    "contract_oid bigint, maturity_date ts, environment string",
    _switched,
    """SELECT c.contract_oid, t.maturity_date, 'test' AS environment FROM lease_contract AS c
       JOIN lease_contract_term AS t ON t.contract_oid = c.contract_oid WHERE c.is_terminated = 0""",
)
add(
    "s04_inline_table",
    "oid bigint, state string, vendor_id string",
    lambda c: J.lookup(c.read("location"), vendor_table(c.spark), [("state", "sut_state")], {"vendor_id": "vendor_id"}),
    f"""SELECT l.oid, l.state, v.vendor_id FROM lease_location AS l
        LEFT JOIN (VALUES {_VENDORS}) AS v(sut_state, vendor_id) ON v.sut_state = l.state""",
)


def _batch(c: StarCatalog) -> DataFrame:
    out = write_upsert_batch(
        contract_plans.contracts(c), "contract", "contract_oid", scratch_path(c.spark, "publish"), "b1"
    )
    return _read_batch(c, out)


def _read_batch(c: StarCatalog, path: str) -> DataFrame:
    back = c.spark.read.parquet(path)
    return back.select(
        F.col("ID").alias("id"), F.col("ContractOID__c").alias("contract_oid"), F.col("Opportunity__c").alias("opportunity"),
        F.col("IsTerminated__c").alias("is_terminated"),
    )


add(
    "s05_upsert_batch",
    "id string, contract_oid bigint, opportunity string, is_terminated int",
    _batch,
    f"""SELECT CAST(NULL AS VARCHAR) AS id, c.contract_oid, o.opportunity, c.is_terminated FROM lease_contract AS c
        JOIN {OPP} AS o ON o.ref_oid = c.contract_oid""",
)


# --- filters ------------------------------------------------------------------------------

add(
    "f01_projection",
    "id string, contract_oid bigint, contract_name string, department int, currency string, note string",
    lambda c: P.project(
        c.read("contract"),
        {"contract_oid": F.col("contract_oid"), "contract_name": F.lower("contract_id"), "department": 10, "currency": "USD", "note": ""},
        with_id=True,
    ),
    """SELECT NULL AS id, contract_oid, LOWER(contract_id) AS contract_name, 10 AS department, 'USD' AS currency, '' AS note
       FROM lease_contract""",
)
add(
    "f02_contract_scope",
    "contract_oid bigint, is_terminated int",
    lambda c: union_arms(*[P.contract_scope(c.read("contract"), terminated=t) for t in (0, 1)]),
    "SELECT * FROM lease_contract WHERE is_booked = 1 AND company_oid = 1",
)
add(
    "f03_change_window",
    "oid bigint, last_change_datetime ts",
    lambda c: P.changed_between(c.read("comment"), "last_change_datetime", NOTE_WINDOW),
    f"SELECT * FROM lease_comment WHERE last_change_datetime BETWEEN {TS(NOTE_START)} AND {TS(NOTE_END)}",
)
add(
    "f04_change_window_any",
    "invoice_detail_oid bigint, line_change ts, contract_change ts",
    lambda c: P.changed_between_any(
        J.lookup(
            c.read("invoice_detail").withColumnRenamed("last_change_datetime", "line_change"),
            c.read("contract"),
            "contract_oid",
            {"last_change_datetime": "contract_change"},
        ),
        ["line_change", "contract_change"],
        WINDOW,
    ),
    f"""SELECT d.invoice_detail_oid, d.last_change_datetime AS line_change, c.last_change_datetime AS contract_change
        FROM lease_invoice_detail AS d LEFT JOIN lease_contract AS c ON c.contract_oid = d.contract_oid
        WHERE d.last_change_datetime {IN_WINDOW} OR c.last_change_datetime {IN_WINDOW}""",
)
add(
    "f05_code_list",
    "invoice_detail_oid bigint, transaction_code_oid bigint, open_closed_oid bigint",
    lambda c: c.read("invoice_detail").filter(
        P.in_codes("transaction_code_oid", G.RENT_CODES) & P.in_codes("open_closed_oid", G.CLOSED_STATES, negate=True)
    ),
    """SELECT * FROM lease_invoice_detail WHERE transaction_code_oid IN (1, 35, 25, 37, 43)
       AND open_closed_oid NOT IN (11022, 11023)""",
)


def _routes(c: StarCatalog) -> DataFrame:
    listed, other = _split(c)
    return union_arms(listed.withColumn("route", F.lit("multi")), other.withColumn("route", F.lit("single")))


def _split(c: StarCatalog) -> tuple[DataFrame, DataFrame]:
    entities = c.read("entity").select("oid", "name")
    return J.member_split(entities, "oid", multi_deal_entities(c.read("contract"), 10))


add(
    "f06_key_list_split",
    "oid bigint, name string, route string",
    _routes,
    """SELECT e.oid, e.name, CASE WHEN n.entity_oid IS NOT NULL THEN 'multi' ELSE 'single' END AS route FROM lease_entity AS e
       LEFT JOIN (SELECT entity_oid FROM lease_contract GROUP BY entity_oid HAVING COUNT(*) > 10) AS n ON n.entity_oid = e.oid""",
)
add(
    "f07_pattern_filter",
    "p_partkey bigint, p_name string",
    lambda c: c.star("part").filter(P.contains("p_name", "RING", ignore_case=True) & P.contains("p_name", "red", negate=True)),
    "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%ring%' AND p_name NOT LIKE '%red%'",
)
add(
    "f08_null_filter",
    "oid bigint, text string",
    lambda c: P.require(c.read("comment"), "oid", "text"),
    "SELECT oid, text FROM lease_comment WHERE oid IS NOT NULL AND NOT (text IS NULL)",
)
add(
    "f09_month_filter",
    "general_ledger_oid bigint, post_date ts",
    lambda c: c.read("general_ledger").filter(P.in_month("post_date", JOURNAL_MONTH)),
    f"SELECT * FROM lease_general_ledger WHERE post_date > {TS('1998-09-30')} AND post_date <= {TS('1998-10-31')}",
)


def _flagged(c: StarCatalog) -> DataFrame:
    draft = F.col("account_id").isin("01-20025", "01-10040")
    out = P.flag_groups(c.read("general_ledger"), draft, "journal_number", "group_hit")
    return out.withColumn("row_hit", P.row_predicate(draft, "journal_number").cast("int"))


add(
    "f10_row_predicate",
    "general_ledger_oid bigint, journal_number bigint, account_id string, row_hit int, group_hit int",
    _flagged,
    """SELECT general_ledger_oid, journal_number, account_id, CASE WHEN account_id IN ('01-20025', '01-10040') THEN 1 ELSE 0 END AS row_hit,
         MAX(CASE WHEN account_id IN ('01-20025', '01-10040') THEN 1 ELSE 0 END) OVER (PARTITION BY journal_number) AS group_hit
       FROM lease_general_ledger""",
)
add(
    "f11_compound_exclusion",
    "general_ledger_oid bigint, account_id string, process_oid bigint",
    lambda c: P.exclude(
        c.read("general_ledger").filter((F.col("debit") != 0) | (F.col("credit") != 0)),
        (P.contains("account_id", "100") | P.contains("account_id", "200")) & F.col("process_oid").isin(20119, 20143),
    ),
    """SELECT * FROM lease_general_ledger WHERE (debit <> 0 OR credit <> 0)
       AND NOT ((account_id LIKE '%100%' OR account_id LIKE '%200%') AND (process_oid = 20119 OR process_oid = 20143))""",
)
add(
    "f12_comparisons",
    "invoice_detail_oid bigint, due_date ts, current_due_amount double",
    lambda c: c.read("invoice_detail").filter(
        (F.col("due_date") <= ts(AS_OF)) & ~(F.col("current_due_amount") == 0) & ((F.col("is_paid") != 1) | (F.col("original_due_amount") > 90000))
    ),
    f"""SELECT * FROM lease_invoice_detail WHERE due_date <= {TS(AS_OF)} AND NOT (current_due_amount = 0)
        AND (is_paid <> 1 OR original_due_amount > 90000)""",
)


def _named_steps(c: StarCatalog) -> DataFrame:
    lines = c.read("invoice_detail").filter(F.col("is_paid") == 0)
    per_contract = lines.groupBy("contract_oid").agg(F.sum("current_due_amount").alias("due"))
    return per_contract.join(P.contract_scope(c.read("contract")).select("contract_oid", "entity_oid"), "contract_oid").groupBy("entity_oid").agg(
        F.sum("due").alias("due"), F.count(F.lit(1)).alias("contracts")
    )


add(
    "f13_named_steps",
    "entity_oid bigint, due double, contracts bigint",
    _named_steps,
    """WITH unpaid AS (SELECT * FROM lease_invoice_detail WHERE is_paid = 0),
       per AS (SELECT contract_oid, SUM(current_due_amount) AS due FROM unpaid GROUP BY contract_oid)
       SELECT c.entity_oid, SUM(per.due) AS due, COUNT(*) AS contracts FROM per JOIN lease_contract AS c ON c.contract_oid = per.contract_oid
       WHERE c.is_booked = 1 AND c.company_oid = 1 GROUP BY c.entity_oid""",
)

# --- joins --------------------------------------------------------------------------------

add(
    "j01_left_star",
    "general_ledger_oid bigint, contract_id string, name string, account_title string",
    lambda c: J.star_left(
        c.read("general_ledger"),
        [
            (
                c.read("general_ledger_account_id"),
                "general_ledger_account_id_oid",
                {"contract_oid": "contract_oid", "gl_accounts_oid": "gl_accounts_oid"},
            ),
            (c.read("contract"), "contract_oid", {"contract_id": "contract_id", "entity_oid": "entity_oid"}),
            (c.read("entity"), [("entity_oid", "oid")], {"name": "name"}),
            (c.read("gl_accounts"), "gl_accounts_oid", {"account_title": "account_title"}),
        ],
    ),
    """SELECT g.general_ledger_oid, c.contract_id, e.name, t.account_title FROM lease_general_ledger AS g
       LEFT JOIN lease_general_ledger_account_id AS a ON a.general_ledger_account_id_oid = g.general_ledger_account_id_oid
       LEFT JOIN lease_contract AS c ON c.contract_oid = a.contract_oid LEFT JOIN lease_entity AS e ON e.oid = c.entity_oid
       LEFT JOIN lease_gl_accounts AS t ON t.gl_accounts_oid = a.gl_accounts_oid""",
)
add(
    "j02_inner_join",
    "contract_oid bigint, invoice_detail_oid bigint, contract_id string",
    lambda c: J.lookup(c.read("invoice_detail"), c.read("contract"), "contract_oid", {"contract_id": "contract_id"}, "inner"),
    """SELECT d.contract_oid, d.invoice_detail_oid, c.contract_id FROM lease_invoice_detail AS d
       JOIN lease_contract AS c ON c.contract_oid = d.contract_oid""",
)
add(
    "j03_right_outer",
    "oid bigint, name string, contract_oid bigint",
    lambda c: c.read("contract").select("contract_oid", "entity_oid").join(
        c.read("entity").select("oid", "name"), F.expr("entity_oid = oid"), "right"
    ),
    "SELECT e.oid, e.name, c.contract_oid FROM lease_contract AS c RIGHT JOIN lease_entity AS e ON e.oid = c.entity_oid",
)
add(
    "j04_nested_left",
    "contract_oid bigint, invoice_detail_oid bigint, description string",
    lambda c: J.nested_left(
        c.read("contract").select("contract_oid"),
        c.read("invoice_detail").select("contract_oid", "invoice_detail_oid", "transaction_code_oid"),
        c.read("transaction_code"),
        "contract_oid",
        "transaction_code_oid",
        {"description": "description"},
    ),
    """SELECT c.contract_oid, d.invoice_detail_oid, t.description FROM lease_contract AS c LEFT JOIN (lease_invoice_detail AS d
       LEFT JOIN lease_transaction_code AS t ON t.transaction_code_oid = d.transaction_code_oid) ON d.contract_oid = c.contract_oid""",
)
add(
    "j05_two_key_join",
    "invoice_detail_oid bigint, invoice_header_oid bigint, contract_oid bigint, is_posted int",
    lambda c: J.lookup(c.read("invoice_detail"), c.read("invoice_header"), ["contract_oid", "invoice_header_oid"], {"is_posted": "is_posted"}),
    """SELECT d.invoice_detail_oid, d.invoice_header_oid, d.contract_oid, h.is_posted FROM lease_invoice_detail AS d
       LEFT JOIN lease_invoice_header AS h ON h.contract_oid = d.contract_oid AND h.invoice_header_oid = d.invoice_header_oid""",
)
add(
    "j06_self_join",
    "oid bigint, name string, collector_oid bigint, collector_name string",
    lambda c: J.self_lookup(c.read("entity"), "collector_oid", "oid", {"name": "collector_name"}),
    """SELECT e.oid, e.name, e.collector_oid, k.name AS collector_name FROM lease_entity AS e
       LEFT JOIN lease_entity AS k ON k.oid = e.collector_oid""",
)
add(
    "j07_code_lookup",
    "oid bigint, message_type string, message_label string, tag string",
    lambda c: J.code_lookup(
        J.code_lookup(c.read("comment"), c.read("lti_values"), "message_type", {"descr": "message_label"}, "EVENT", "data_value").withColumn(
            "code", F.when(F.col("message_type") == "click", 20119).otherwise(20120)
        ),
        c.read("lti_values"),
        "code",
        {"descr": "tag"},
    ),
    """SELECT m.oid, m.message_type, v.descr AS message_label,
         CASE WHEN m.message_type = 'click' THEN 'Booking' ELSE 'Asset Sale' END AS tag FROM lease_comment AS m
       LEFT JOIN lease_lti_values AS v ON v.table_key = 'EVENT' AND v.data_value = m.message_type""",
)
_SPANS = f"""(SELECT k.entity_oid, k.contract_oid, t.start_date, k.termination_date, COALESCE(k.termination_date, {TS(AS_OF)}) AS until_date
  FROM lease_contract AS k JOIN lease_contract_term AS t ON t.contract_oid = k.contract_oid)"""


def _spans(c: StarCatalog) -> DataFrame:
    term = c.read("contract_term").select("contract_oid", "start_date")
    return c.read("contract").join(term, "contract_oid").select("entity_oid", "contract_oid", "start_date", "termination_date")


def _account_comments(c: StarCatalog) -> DataFrame:
    m = c.read("comment").filter(F.col("ref_type") == "ACCT")
    return m.select("oid", F.col("ref_oid").alias("entity_oid"), "create_datetime")


add(
    "j08_interval_join",
    "oid bigint, entity_oid bigint, contract_oid bigint, create_datetime ts",
    lambda c: J.interval_join(_account_comments(c), _spans(c), "entity_oid", "create_datetime", "start_date", "termination_date", AS_OF),
    f"""SELECT m.oid, m.ref_oid AS entity_oid, s.contract_oid, m.create_datetime FROM lease_comment AS m JOIN {_SPANS} AS s
        ON s.entity_oid = m.ref_oid AND m.create_datetime BETWEEN s.start_date AND s.until_date WHERE m.ref_type = 'ACCT'""",
)
add(
    "j08_interval_least",
    "oid bigint, entity_oid bigint, contract_oid bigint, create_datetime ts",
    lambda c: J.interval_min(
        _account_comments(c), _spans(c), "entity_oid", "create_datetime", "start_date", "termination_date", ["contract_oid"], "oid", AS_OF
    ),
    f"""SELECT m.oid, m.ref_oid AS entity_oid, MIN(s.contract_oid) AS contract_oid, m.create_datetime FROM lease_comment AS m JOIN {_SPANS} AS s
        ON s.entity_oid = m.ref_oid AND m.create_datetime BETWEEN s.start_date AND s.until_date WHERE m.ref_type = 'ACCT'
        GROUP BY m.oid, m.ref_oid, m.create_datetime""",
)
add(
    "j09_existence",
    "contract_oid bigint, contract_id string",
    lambda c: J.require_match(c.read("contract"), c.read("generic_value").filter(F.col("genf_oid") == 23), [("contract_oid", "ref_oid")]),
    """SELECT c.contract_oid, c.contract_id FROM lease_contract AS c LEFT JOIN (SELECT DISTINCT ref_oid FROM lease_generic_value
       WHERE genf_oid = 23) AS v ON v.ref_oid = c.contract_oid WHERE v.ref_oid IS NOT NULL""",
)
add(
    "j10_extreme_rows",
    "contract_oid bigint, payment_oid bigint, effective_date ts, how string",
    lambda c: union_arms(
        *[
            J.extreme_rows(c.read("payment"), ["contract_oid"], "effective_date", how).withColumn("how", F.lit(how))
            for how in ("max", "min")
        ]
    ),
    """SELECT p.*, 'max' AS how FROM lease_payment AS p JOIN (SELECT contract_oid, MAX(effective_date) AS at_date FROM lease_payment
         GROUP BY contract_oid) AS m ON m.contract_oid = p.contract_oid AND m.at_date = p.effective_date
       UNION ALL SELECT p.*, 'min' AS how FROM lease_payment AS p JOIN (SELECT contract_oid, MIN(effective_date) AS at_date
         FROM lease_payment GROUP BY contract_oid) AS m ON m.contract_oid = p.contract_oid AND m.at_date = p.effective_date""",
)
add(
    "j11_vendor_lookup",
    "oid bigint, state string, account string, vendor_id string",
    lambda c: J.lookup(
        c.read("location").withColumn("account", F.when(F.col("oid") < 0, "20007").otherwise("20006")),
        vendor_table(c.spark),
        [("state", "sut_state")],
        {"vendor_id": "by_state"},
    ).withColumn("vendor_id", F.when(F.col("account") == "20007", "V00296").otherwise(F.col("by_state"))),
    f"""SELECT l.oid, l.state, CASE WHEN l.oid < 0 THEN '20007' ELSE '20006' END AS account,
          CASE WHEN l.oid < 0 THEN 'V00296' ELSE v.vendor END AS vendor_id FROM lease_location AS l
        LEFT JOIN (VALUES {_VENDORS}) AS v(sut_state, vendor) ON v.sut_state = l.state""",
)

# --- aggregates ---------------------------------------------------------------------------

_GL = """(SELECT a.contract_oid, g.account_id, g.process_oid, g.post_date, COALESCE(g.debit, 0) + COALESCE(g.credit, 0) AS amt
  FROM lease_general_ledger AS g JOIN lease_general_ledger_account_id AS a
  ON a.general_ledger_account_id_oid = g.general_ledger_account_id_oid)"""
add(
    "g01_conditional_sums",
    "journal_number bigint, gross double, unearned double, deposit double",
    lambda c: G.bucket_sums(
        c.read("general_ledger"),
        ["journal_number"],
        G.LEDGER_AMOUNT,
        [
            G.gross_bucket("gross", G.GROSS_PROCESSES),
            G.Bucket("unearned", f"account_id = '{G.UNEARNED_ACCOUNT}'", -1),
            G.Bucket("deposit", f"account_id = '{G.DEPOSIT_ACCOUNT}' AND process_oid = 20119", -1, 0),
        ],
    ),
    """SELECT journal_number, SUM(CASE WHEN account_id = '01-10089' AND process_oid IN (20119, 20126, 20127, 20140, 20141, 20143)
         THEN COALESCE(debit, 0) + COALESCE(credit, 0) END) AS gross,
       SUM(CASE WHEN account_id = '01-10092' THEN -(COALESCE(debit, 0) + COALESCE(credit, 0)) END) AS unearned,
       COALESCE(SUM(CASE WHEN account_id = '01-10130' AND process_oid = 20119 THEN -(COALESCE(debit, 0) + COALESCE(credit, 0)) END), 0)
         AS deposit FROM lease_general_ledger GROUP BY journal_number""",
)
add(
    "g02_ledger_snapshot",
    "contract_oid bigint, gross_receivable double, original_gross_receivable double, balance_remaining double, unearned_finance double,"
    " residual double, deferred_residual double, deferred_expense double, security_deposit double",
    lambda c: G.ledger_snapshot(c.read("general_ledger"), c.read("general_ledger_account_id"), AS_OF),
    f"""SELECT contract_oid,
          SUM(amt) FILTER (WHERE account_id = '01-10089' AND process_oid IN (20119, 20126, 20127, 20140, 20141, 20143)) AS gross_receivable,
          COALESCE(SUM(amt) FILTER (WHERE account_id = '01-10089' AND process_oid IN (20119, 20126, 20127, 20140)), 0)
            AS original_gross_receivable,
          SUM(amt) FILTER (WHERE account_id IN ('01-10089', '01-10090')) AS balance_remaining,
          -SUM(amt) FILTER (WHERE account_id = '01-10092') AS unearned_finance, SUM(amt) FILTER (WHERE account_id = '01-10091') AS residual,
          -SUM(amt) FILTER (WHERE account_id = '01-10093') AS deferred_residual,
          SUM(amt) FILTER (WHERE account_id = '01-10094') AS deferred_expense, -SUM(amt) FILTER (WHERE account_id = '01-10130') AS security_deposit
        FROM {_GL} AS l WHERE post_date <= {TS(AS_OF)} GROUP BY contract_oid""",
)
add(
    "g03_regroup",
    "contract_oid bigint, occurrences bigint, first_start ts, earliest_last ts, top_operator string",
    lambda c: G.regroup(
        c.read("payment_stream"),
        ["contract_oid", "last_change_datetime", "last_change_operator"],
        [F.sum("occurrences").alias("n"), F.min("start_date").alias("lo"), F.max("start_date").alias("hi")],
        ["contract_oid"],
        [
            F.sum("n").alias("occurrences"),
            F.min("lo").alias("first_start"),
            F.min("hi").alias("earliest_last"),
            F.max("last_change_operator").alias("top_operator"),
        ],
    ),
    """SELECT contract_oid, SUM(n) AS occurrences, MIN(lo) AS first_start, MIN(hi) AS earliest_last, MAX(last_change_operator) AS top_operator
       FROM (SELECT contract_oid, last_change_datetime, last_change_operator, SUM(occurrences) AS n, MIN(start_date) AS lo,
         MAX(start_date) AS hi FROM lease_payment_stream GROUP BY ALL) AS f GROUP BY contract_oid""",
)
add(
    "g04_min_max",
    "contract_oid bigint, first_due ts, last_due ts",
    lambda c: c.read("invoice_detail").groupBy("contract_oid").agg(F.min("due_date").alias("first_due"), F.max("due_date").alias("last_due")),
    "SELECT contract_oid, MIN(due_date) AS first_due, MAX(due_date) AS last_due FROM lease_invoice_detail GROUP BY contract_oid",
)
add(
    "g05_count_flag",
    "contract_oid bigint, flagged bigint, returned bigint",
    lambda c: G.count_flag(c.read("payment"), ["contract_oid"], "is_returned", "flagged").join(
        G.count_flag(c.read("payment"), ["contract_oid"], "is_returned", "returned", only_set=True), "contract_oid"
    ),
    """SELECT contract_oid, COUNT(is_returned) AS flagged, COUNT(*) FILTER (WHERE is_returned = 1) AS returned FROM lease_payment
       GROUP BY contract_oid""",
)
add(
    "g06_split_totals",
    "schedule_definition_oid bigint, invoiced bigint, uninvoiced bigint",
    lambda c: G.split_sums(c.read("payment_stream"), ["schedule_definition_oid"], "occurrences", "is_invoiced", ("invoiced", "uninvoiced")),
    """SELECT schedule_definition_oid, SUM(CASE WHEN is_invoiced = 1 THEN occurrences ELSE 0 END) AS invoiced,
       SUM(CASE WHEN is_invoiced = 0 THEN occurrences ELSE 0 END) AS uninvoiced FROM lease_payment_stream GROUP BY schedule_definition_oid""",
)
add(
    "g07_aggregate_arithmetic",
    "payment_stream_oid bigint, amount double, total_due double, top_sum double",
    lambda c: c.read("payment_stream")
    .join(c.read("payment_stream_contract_item").drop("last_change_datetime"), "payment_stream_oid")
    .groupBy("payment_stream_oid", "amount")
    .agg(
        (F.sum("occurrences") * F.col("amount")).alias("total_due"),
        (F.max("amount") + F.max("on_stream_tax_amount")).alias("top_sum"),
    ),
    """SELECT p.payment_stream_oid, i.amount, SUM(p.occurrences) * i.amount AS total_due, MAX(i.amount) + MAX(i.on_stream_tax_amount) AS top_sum
       FROM lease_payment_stream AS p JOIN lease_payment_stream_contract_item AS i ON i.payment_stream_oid = p.payment_stream_oid
       GROUP BY p.payment_stream_oid, i.amount""",
)
add(
    "g08_sign_split",
    "journal_number bigint, process_oid bigint, debit double, credit double",
    lambda c: G.sign_split(
        c.read("general_ledger").groupBy("journal_number", "process_oid").agg(F.expr(f"SUM({G.LEDGER_AMOUNT}) AS net")), "net"
    ),
    """SELECT journal_number, process_oid, CASE WHEN net >= 0 THEN net END AS debit, CASE WHEN net < 0 THEN -net END AS credit FROM (
         SELECT journal_number, process_oid, SUM(COALESCE(debit, 0) + COALESCE(credit, 0)) AS net FROM lease_general_ledger GROUP BY ALL) AS g""",
)
add(
    "g09_group_as_distinct",
    "contract_oid bigint, reason_code_oid bigint, last_rewrite bigint",
    lambda c: c.read("contract_rewrite").groupBy("contract_oid", "reason_code_oid").agg(F.max("contract_rewrite_oid").alias("last_rewrite")),
    """SELECT contract_oid, reason_code_oid, MAX(contract_rewrite_oid) AS last_rewrite FROM lease_contract_rewrite
       GROUP BY contract_oid, reason_code_oid""",
)
add(
    "g10_distinct",
    "contract_oid bigint, frequency string, is_invoiced int",
    lambda c: c.read("payment_stream").select("contract_oid", "frequency", "is_invoiced").distinct(),
    "SELECT DISTINCT contract_oid, frequency, is_invoiced FROM lease_payment_stream",
)
add(
    "g11_oldest_unpaid",
    "contract_oid bigint, oldest_due ts",
    lambda c: G.oldest_unpaid(c.read("invoice_detail"), c.read("invoice_payment_history"), AS_OF),
    f"""WITH due AS (SELECT contract_oid, invoice_header_oid, due_date, SUM(original_due_amount) AS amount FROM lease_invoice_detail
          WHERE due_date <= {TS(AS_OF)} AND transaction_code_oid IN (1, 35, 25, 37, 43) AND open_closed_oid NOT IN (11022, 11023) GROUP BY ALL),
        paid AS (SELECT d.contract_oid, d.invoice_header_oid, SUM(h.applied_amount) AS amount FROM lease_invoice_detail AS d
          JOIN lease_invoice_payment_history AS h ON h.invoice_detail_oid = d.invoice_detail_oid
          WHERE d.due_date <= {TS(AS_OF)} AND h.applied_date <= {TS(AS_OF)} AND d.transaction_code_oid IN (1, 35, 25, 37, 43)
            AND d.open_closed_oid NOT IN (11022, 11023) GROUP BY ALL)
        SELECT due.contract_oid, MIN(due.due_date) AS oldest_due FROM due LEFT JOIN paid ON paid.contract_oid = due.contract_oid
          AND paid.invoice_header_oid = due.invoice_header_oid WHERE due.amount > COALESCE(paid.amount, 0) GROUP BY due.contract_oid""",
)
add(
    "g12_invoice_settlement",
    "invoice_detail_oid bigint, total_applied_amount double, pay_in_full_date date",
    lambda c: G.invoice_settlement(c.read("invoice_detail").select("invoice_detail_oid"), invoice_plans.applied_payments(c)),
    """SELECT i.invoice_detail_oid, SUM(p.applied_amount) AS total_applied_amount, CAST(MAX(p.post_date) AS DATE) AS pay_in_full_date
       FROM lease_invoice_detail AS i LEFT JOIN (SELECT d.invoice_detail_oid, d.applied_amount, p.post_date FROM lease_payment AS p
         JOIN lease_cash_receipt_header AS h ON h.payment_oid = p.payment_oid
         JOIN lease_cash_receipt_billable AS b ON b.cash_receipt_header_oid = h.cash_receipt_header_oid
         JOIN lease_cash_receipt_detail AS d ON d.cash_receipt_billable_oid = b.cash_receipt_billable_oid WHERE p.is_returned = 0) AS p
       ON p.invoice_detail_oid = i.invoice_detail_oid GROUP BY i.invoice_detail_oid""",
)

# --- windows, order, unions ---------------------------------------------------------------

add(
    "w01_latest_per_key",
    "equipment_oid bigint, location_oid bigint, start_date ts",
    lambda c: latest_per_key(
        c.read("equipment_location_history"), ["equipment_oid"], [F.col("start_date").desc(), F.col("location_oid").asc()]
    ),
    """SELECT * FROM lease_equipment_location_history
       QUALIFY ROW_NUMBER() OVER (PARTITION BY equipment_oid ORDER BY start_date DESC, location_oid) = 1""",
)


def _journal_lines(c: StarCatalog) -> DataFrame:
    lines = c.read("general_ledger").groupBy("journal_number", "post_date", "general_ledger_account_id_oid", "process_oid").agg(
        F.expr(f"SUM({G.LEDGER_AMOUNT}) AS amount")
    )
    return number_lines(lines, "journal_number", ["post_date", "general_ledger_account_id_oid", "process_oid"])


add(
    "w02_line_numbers",
    "journal_number bigint, line_no bigint, post_date ts, general_ledger_account_id_oid bigint, amount double",
    _journal_lines,
    """SELECT *, ROW_NUMBER() OVER (PARTITION BY journal_number ORDER BY post_date NULLS FIRST, general_ledger_account_id_oid NULLS FIRST,
         process_oid NULLS FIRST) AS line_no FROM (SELECT journal_number, post_date, general_ledger_account_id_oid, process_oid,
         SUM(COALESCE(debit, 0) + COALESCE(credit, 0)) AS amount FROM lease_general_ledger GROUP BY ALL) AS g""",
)
add(
    "o01_final_sort",
    "journal_number bigint, post_day string, general_ledger_oid bigint, amount double",
    lambda c: ordered(
        c.read("general_ledger").select("journal_number", X.us_date("post_date").alias("post_day"), "general_ledger_oid",
                                        F.expr(f"{G.LEDGER_AMOUNT} AS amount")),
        "journal_number", "post_day", "general_ledger_oid", "amount",
    ),
    """SELECT journal_number, STRFTIME(post_date, '%m/%d/%Y') AS post_day, general_ledger_oid, COALESCE(debit, 0) + COALESCE(credit, 0) AS amount
       FROM lease_general_ledger ORDER BY ALL""",
)
add(
    "u01_union_arms",
    "oid bigint, entity_oid bigint, arm string",
    lambda c: union_arms(
        c.read("comment").filter(F.col("ref_type") != "ACCT").select("oid", F.col("ref_oid").alias("entity_oid"), F.lit("contract").alias("arm")),
        c.read("comment").filter(F.col("ref_type") == "ACCT").select(F.lit("account").alias("arm"), "oid", F.col("ref_oid").alias("entity_oid")),
    ),
    """SELECT oid, ref_oid AS entity_oid, 'contract' AS arm FROM lease_comment WHERE ref_type <> 'ACCT'
       UNION ALL SELECT oid, ref_oid, 'account' FROM lease_comment WHERE ref_type = 'ACCT'""",
)

# --- scalar functions ---------------------------------------------------------------------

add(
    "x01_null_default",
    "general_ledger_oid bigint, debit double, credit double, title string",
    lambda c: c.read("general_ledger").select(
        "general_ledger_oid", X.default("debit", 0).alias("debit"), X.default("credit", 0).alias("credit"), X.default(F.lit(None), "none").alias("title")
    ),
    """SELECT general_ledger_oid, COALESCE(debit, 0) AS debit, COALESCE(credit, 0) AS credit, COALESCE(NULL, 'none') AS title
       FROM lease_general_ledger""",
)
add(
    "x02_mask_account",
    "ach_bank_account_oid bigint, masked string, masked_two string",
    lambda c: c.read("ach_bank_account").select(
        "ach_bank_account_oid", X.mask_tail("account_number").alias("masked"), X.mask_tail("account_number", 2, "*").alias("masked_two")
    ),
    """SELECT ach_bank_account_oid,
         CASE WHEN account_number = '' THEN NULL WHEN LENGTH(account_number) < 4 THEN REPEAT('x', LENGTH(account_number))
           ELSE REPEAT('x', LENGTH(account_number) - 4) || RIGHT(account_number, 4) END AS masked,
         CASE WHEN account_number = '' THEN NULL WHEN LENGTH(account_number) < 2 THEN REPEAT('*', LENGTH(account_number))
           ELSE REPEAT('*', LENGTH(account_number) - 2) || RIGHT(account_number, 2) END AS masked_two
       FROM lease_ach_bank_account""",
)
_LINE = "CASE WHEN TRIM({0}) <> '' THEN {0} || ', ' ELSE '' END".format
add(
    "x03_address",
    "oid bigint, address string, full_address string",
    lambda c: c.read("location").select(
        "oid",
        X.join_address(["addr_line1", "addr_line2", "addr_line3"], "city", "state").alias("address"),
        X.full_address("addr_line1", "addr_line2", "city", "state", "postal_code").alias("full_address"),
    ),
    f"""SELECT oid, {_LINE('addr_line1')} || {_LINE('addr_line2')} || {_LINE('addr_line3')} || COALESCE(city, '') || ', ' || COALESCE(state, '') AS address,
          COALESCE(addr_line1, '') || COALESCE(addr_line2, '') || ', ' || COALESCE(city, '') || ', ' || COALESCE(state, '') || ' '
            || COALESCE(postal_code, '') AS full_address FROM lease_location""",
)
_WORD = "CASE WHEN TRIM(COALESCE({0}, '')) = '' THEN '' ELSE TRIM({0}) || ' ' END".format
add(
    "x04_party_name",
    "oid bigint, party string",
    lambda c: c.read("entity").select("oid", X.party_name("bus_or_ind", "name", "fname", "mname", "lname", "suffix").alias("party")),
    f"""SELECT oid, CASE WHEN bus_or_ind = 'B' THEN TRIM(name) ELSE RTRIM({_WORD('fname')} || {_WORD('mname')} || {_WORD('lname')}
          || {_WORD('suffix')}) END AS party FROM lease_entity""",
)
add(
    "x05_composite_key",
    "contract_oid bigint, plain_key string, safe_key string",
    lambda c: c.read("contract").select(
        "contract_oid",
        X.composite_key("contract_oid", "entity_oid", X.prefix("tax_treatment", 1)).alias("plain_key"),
        X.composite_key("contract_oid", "entity_oid", "termination_date", sep="-").substr(1, 12).alias("safe_key"),
    ),
    """SELECT contract_oid, contract_oid || '' || entity_oid || LEFT(tax_treatment, 1) AS plain_key,
         LEFT(contract_oid || '-' || entity_oid || '-' || COALESCE(CAST(termination_date AS VARCHAR), ''), 12) AS safe_key FROM lease_contract""",
)
add(
    "x06_prefix",
    "gl_accounts_oid bigint, lines bigint, title_account string",
    lambda c: c.read("general_ledger_account_id")
    .groupBy("gl_accounts_oid")
    .agg(F.count(F.lit(1)).alias("lines"))
    .join(c.read("gl_accounts"), "gl_accounts_oid")
    .withColumn("title_account", X.prefix("account_title", 5)),
    """SELECT a.gl_accounts_oid, COUNT(*) AS lines, LEFT(MAX(t.account_title), 5) AS title_account FROM lease_general_ledger_account_id AS a
       JOIN lease_gl_accounts AS t ON t.gl_accounts_oid = a.gl_accounts_oid GROUP BY a.gl_accounts_oid""",
)
add(
    "x07_memo",
    "contract_oid bigint, memo string",
    lambda c: J.lookup(c.read("contract"), c.read("entity"), [("entity_oid", "oid")], {"name": "name", "alt_name": "alt_name"}).select(
        "contract_oid", X.memo(X.classify_contract("contract_id"), "contract_id", "name", "alt_name").alias("memo")
    ),
    """SELECT c.contract_oid, CASE WHEN c.contract_id LIKE '%R%' THEN 'Rebook' WHEN c.contract_id LIKE '%E%' THEN 'EFA' ELSE 'Lease' END
         || ' #' || c.contract_id || ' ' || e.name || ' - ' || e.alt_name AS memo
       FROM lease_contract AS c LEFT JOIN lease_entity AS e ON e.oid = c.entity_oid""",
)
add(
    "x08_classify",
    "contract_item_oid bigint, label string, contract_oid bigint",
    lambda c: c.read("contract_disposed_asset").withColumn("label", X.disposal_label("disposal_type")),
    """SELECT contract_item_oid, contract_oid, CASE WHEN disposal_type IS NULL THEN 'Not Disposed' WHEN disposal_type IN ('Sale', 'Inventory', 'Abandon')
         THEN disposal_type ELSE 'ERROR' END AS label FROM lease_contract_disposed_asset""",
)
add(
    "x08_journal_type",
    "process_oid bigint, journal string, ledger_rows bigint",
    lambda c: c.read("general_ledger").groupBy("process_oid", X.classify("process_oid", X.JOURNAL_TYPES).alias("journal")).agg(
        F.count(F.lit(1)).alias("ledger_rows")
    ),
    """SELECT process_oid, CASE WHEN process_oid = 20119 THEN 'BKJ' WHEN process_oid IN (20120, 20121) THEN 'ASBJ'
         WHEN process_oid IN (20122, 20134, 20135) THEN 'ACRJ' WHEN process_oid = 20123 THEN 'ABAJ' WHEN process_oid IN (20126, 20127) THEN 'AMJ'
         WHEN process_oid IN (20140, 20141) THEN 'CMJ' WHEN process_oid = 20128 THEN 'ACJ' WHEN process_oid = 20143 THEN 'DPJ' END AS journal,
         COUNT(*) AS ledger_rows FROM lease_general_ledger GROUP BY process_oid""",
)


def _reclassed(c: StarCatalog) -> DataFrame:
    g = c.read("general_ledger").groupBy("journal_number", "account_id").agg(
        F.sum("debit").alias("d"), F.expr(f"SUM({G.LEDGER_AMOUNT}) AS net"), F.max("process_oid").alias("p")
    )
    g = g.withColumn("raw", F.when(F.col("account_id") == "01-10090", "42001").otherwise("15001"))
    reason = F.when(F.col("p") > 20140, "I")
    return g.withColumn("account", X.reclass("raw", "net", F.when(F.col("net") >= 0, F.col("d")), reason))


add(
    "x09_reclassify",
    "journal_number bigint, account_id string, account string",
    _reclassed,
    """SELECT journal_number, account_id, CASE WHEN account_id = '01-10090' THEN CASE WHEN net >= 0 THEN '14000' WHEN p > 20140 THEN '42002'
         ELSE '42001' END ELSE '15001' END AS account FROM (SELECT journal_number, account_id, MAX(process_oid) AS p,
         SUM(COALESCE(debit, 0) + COALESCE(credit, 0)) AS net FROM lease_general_ledger GROUP BY journal_number, account_id) AS g""",
)
add(
    "x10_days_past_due",
    "invoice_detail_oid bigint, dpd bigint",
    lambda c: c.read("invoice_detail").select("invoice_detail_oid", X.days_past_due("due_date", ts(AS_OF)).alias("dpd")),
    f"SELECT invoice_detail_oid, GREATEST(DATE_DIFF('day', due_date, {TS(AS_OF)}), 0) AS dpd FROM lease_invoice_detail",
)
add(
    "x11_rounded_days",
    "oid bigint, days bigint",
    lambda c: c.read("comment").select("oid", X.days_between_rounded("last_change_datetime", ts("2024-01-01 06:00:00")).alias("days")),
    """SELECT oid, CAST(FLOOR(DATE_DIFF('microsecond', TIMESTAMP '2024-01-01 06:00:00', last_change_datetime) / 86400000000.0 + 0.5) AS BIGINT) AS days
       FROM lease_comment""",
)
add(
    "x12_date_text",
    "oid bigint, day date, text_day string",
    lambda c: c.read("comment").select("oid", F.to_date("last_change_datetime").alias("day"), X.us_date("last_change_datetime").alias("text_day")),
    "SELECT oid, CAST(last_change_datetime AS DATE) AS day, STRFTIME(last_change_datetime, '%m/%d/%Y') AS text_day FROM lease_comment",
)
_NOW = "1999-02-15 00:00:00"
add(
    "x13_next_due_date",
    "invoice_detail_oid bigint, next_due date",
    lambda c: J.lookup(c.read("invoice_detail"), c.read("contract"), "contract_oid", {"is_terminated": "is_terminated"}).select(
        "invoice_detail_oid", X.next_due_date("due_date", "last_change_datetime", _NOW, "is_terminated").alias("next_due")
    ),
    f"""SELECT d.invoice_detail_oid, CASE WHEN d.due_date > {TS(_NOW)} THEN CAST(d.last_change_datetime AS DATE)
          WHEN c.is_terminated = 0 AND DAY(d.due_date) > 15 AND MONTH(d.due_date) = 12
            THEN CAST(TRY_CAST('2000-01-' || LPAD(CAST(DAY(d.due_date) AS VARCHAR), 2, '0') AS DATE) + INTERVAL 1 MONTH AS DATE)
          WHEN c.is_terminated = 0 AND DAY(d.due_date) > 15 THEN TRY_CAST('1999-02-' || LPAD(CAST(DAY(d.due_date) AS VARCHAR), 2, '0') AS DATE)
          WHEN c.is_terminated = 0 AND DAY(d.due_date) < 15
            THEN CAST(TRY_CAST('1999-02-' || LPAD(CAST(DAY(d.due_date) AS VARCHAR), 2, '0') AS DATE) + INTERVAL 1 MONTH AS DATE) END AS next_due
        FROM lease_invoice_detail AS d JOIN lease_contract AS c ON c.contract_oid = d.contract_oid""",
)
add(
    "x14_latest_of_three",
    "contract_oid bigint, latest ts, who string",
    lambda c: J.lookup(c.read("contract"), c.read("contract_term"), "contract_oid", {"start_date": "start_date"}).select(
        "contract_oid",
        X.latest_of(["last_change_datetime", "non_accrual_effective_date", "termination_date"]).alias("latest"),
        X.latest_of(
            ["last_change_datetime", "non_accrual_effective_date", "termination_date"], [F.lit("change"), F.lit("accrual"), F.lit("end")]
        ).alias("who"),
    ),
    """SELECT contract_oid, CASE WHEN a >= b AND a >= z THEN a WHEN b >= a AND b >= z THEN b ELSE z END AS latest,
         CASE WHEN a >= b AND a >= z THEN 'change' WHEN b >= a AND b >= z THEN 'accrual' ELSE 'end' END AS who
       FROM (SELECT contract_oid, last_change_datetime AS a, non_accrual_effective_date AS b, termination_date AS z FROM lease_contract) AS t""",
)
add(
    "x15_text_cast",
    "ref_oid bigint, least_text string, id_text string",
    lambda c: c.read("comment").groupBy("ref_oid").agg(F.min(F.col("text").cast("string")).alias("least_text")).withColumn(
        "id_text", F.col("ref_oid").cast("string")
    ),
    "SELECT ref_oid, MIN(CAST(text AS VARCHAR)) AS least_text, CAST(ref_oid AS VARCHAR) AS id_text FROM lease_comment GROUP BY ref_oid",
)


def _net_investments(c: StarCatalog) -> DataFrame:
    s = G.ledger_snapshot(c.read("general_ledger"), c.read("general_ledger_account_id"), AS_OF)
    terms = ("balance_remaining", "unearned_finance", "residual", "deferred_residual", "deferred_expense", "security_deposit")
    return s.select(
        "contract_oid",
        X.net_investment(*terms).alias("net_investment"),
        X.net_investment(*terms, at_termination=True).alias("at_termination"),
        (F.col("gross_receivable") - F.col("balance_remaining")).alias("payments_made"),
    )


_TERM_SUM = """COALESCE(SUM(amt) FILTER (WHERE account_id IN ('01-10092', '01-10091', '01-10093', '01-10094', '01-10130')), 0)"""
add(
    "x16_net_investment",
    "contract_oid bigint, net_investment double, at_termination double, payments_made double",
    _net_investments,
    f"""SELECT contract_oid, COALESCE(SUM(amt) FILTER (WHERE account_id IN ('01-10089', '01-10090')) + {_TERM_SUM}, 0) AS net_investment,
          -(COALESCE(SUM(amt) FILTER (WHERE account_id IN ('01-10089', '01-10090')), 0) + {_TERM_SUM}) AS at_termination,
          SUM(amt) FILTER (WHERE account_id = '01-10089' AND process_oid IN (20119, 20126, 20127, 20140, 20141, 20143))
            - SUM(amt) FILTER (WHERE account_id IN ('01-10089', '01-10090')) AS payments_made
        FROM {_GL} AS l WHERE post_date <= {TS(AS_OF)} GROUP BY contract_oid""",
)
add(
    "x17_conditional_blank",
    "contract_oid bigint, rate double, treatment string, changed ts",
    lambda c: c.read("contract").select(
        "contract_oid",
        X.blank_when(F.col("is_terminated") == 1, "implicit_rate", 0).alias("rate"),
        X.blank_when(F.col("is_booked") == 0, "tax_treatment", "").alias("treatment"),
        X.blank_when(F.col("company_oid") == 2, "last_change_datetime").alias("changed"),
    ),
    """SELECT contract_oid, CASE WHEN is_terminated = 1 THEN 0 ELSE implicit_rate END AS rate,
         CASE WHEN is_booked = 0 THEN '' ELSE tax_treatment END AS treatment,
         CASE WHEN company_oid = 2 THEN NULL ELSE last_change_datetime END AS changed FROM lease_contract""",
)
add(
    "x18_rate_text",
    "line_item_oid bigint, rate string, rate_percent string",
    lambda c: c.read("amort_line_item").select("line_item_oid", X.rate_text("new_rate").alias("rate"), X.rate_text("new_rate", "%").alias("rate_percent")),
    """SELECT line_item_oid, CAST(CAST(new_rate * 100 AS DECIMAL(22,8)) AS VARCHAR) AS rate,
         CAST(CAST(new_rate * 100 AS DECIMAL(22,8)) AS VARCHAR) || '%' AS rate_percent FROM lease_amort_line_item""",
)
add(
    "x19_lookback_window",
    "oid bigint, last_change_datetime ts",
    lambda c: P.changed_between(c.read("comment"), "last_change_datetime", window_for("2024-01-11 12:00:00", "notes")),
    f"SELECT * FROM lease_comment WHERE last_change_datetime BETWEEN {TS('2024-01-10 12:00:00')} AND {TS('2024-01-11 12:00:00')}",
)

# --- sync ---------------------------------------------------------------------------------

add(
    "r01_attribute_resolve",
    "contract_oid bigint, opportunity string, region string",
    lambda c: R.eav_resolve(
        c.read("generic_field"),
        c.read("generic_value"),
        R.eav_resolve(c.read("generic_field"), c.read("generic_value"), c.read("contract")),
        24,
        name="region",
        default=None,
        how="left",
    ),
    f"""SELECT c.contract_oid, o.opportunity, r.field_value AS region FROM lease_contract AS c JOIN {OPP} AS o ON o.ref_oid = c.contract_oid
        LEFT JOIN (SELECT DISTINCT ref_oid, field_value FROM lease_generic_value WHERE genf_oid = 24) AS r ON r.ref_oid = c.contract_oid""",
)


def _snapshot(c: StarCatalog, as_of: str) -> DataFrame:
    return G.ledger_snapshot(c.read("general_ledger"), c.read("general_ledger_account_id"), as_of)


def _snap_sql(as_of: str) -> str:
    return f"""(SELECT contract_oid, SUM(amt) FILTER (WHERE account_id IN ('01-10089', '01-10090')) AS balance_remaining,
      SUM(amt) FILTER (WHERE account_id = '01-10091') AS residual FROM {_GL} AS l WHERE post_date <= {TS(as_of)} GROUP BY contract_oid)"""


add(
    "r02_snapshot_diff",
    "contract_oid bigint, change_status string, strict_status string",
    lambda c: R.snapshot_diff(
        R.snapshot_diff(
            _snapshot(c, AS_OF), _snapshot(c, PREV_AS_OF), "contract_oid", ["balance_remaining", ("balance_remaining", "residual")]
        ),
        _snapshot(c, PREV_AS_OF),
        "contract_oid",
        ["balance_remaining", "residual"],
        null_safe=True,
        new_rows=True,
        status="strict_status",
    ),
    f"""SELECT n.contract_oid, CASE WHEN n.balance_remaining <> p.balance_remaining
            OR n.balance_remaining - n.residual <> p.balance_remaining - p.residual THEN 'Data Changed' ELSE 'No Changes' END AS change_status,
          CASE WHEN p.contract_oid IS NULL OR n.balance_remaining IS DISTINCT FROM p.balance_remaining OR n.residual IS DISTINCT FROM p.residual
            THEN 'Data Changed' ELSE 'No Changes' END AS strict_status
        FROM {_snap_sql(AS_OF)} AS n LEFT JOIN {_snap_sql(PREV_AS_OF)} AS p ON p.contract_oid = n.contract_oid""",
)

# A small object of its own: payments keyed by id, the amount kept on update.
_PAY = ObjectSpec(
    "payment_state",
    "payment_oid",
    {"payment_oid": "PaymentOid__c", "amount": "Amount__c", "operator": "Operator__c", "changed": "Changed__c"},
    update=("operator", "changed"),
)


def _pay_rows(c: StarCatalog) -> DataFrame:
    return c.read("payment").select(
        "payment_oid", "amount", F.col("last_change_operator").alias("operator"), F.col("last_change_datetime").alias("changed")
    )


def _pay_target(c: StarCatalog) -> DataFrame:
    return _pay_rows(c).filter(F.col("changed") < ts(MIDDLE)).withColumn("operator", F.lit("old")).withColumn("amount", F.col("amount") * 2)


def _pay_source(c: StarCatalog) -> DataFrame:
    return P.changed_between(_pay_rows(c), "changed", WINDOW)


_PAY_ROWS = "SELECT payment_oid, amount, last_change_operator AS operator, last_change_datetime AS changed FROM lease_payment"
_PAY_TARGET = f"""SELECT payment_oid, amount * 2 AS amount, 'old' AS operator, changed FROM ({_PAY_ROWS}) AS r WHERE changed < {TS(MIDDLE)}"""
_PAY_SOURCE = f"SELECT * FROM ({_PAY_ROWS}) AS r WHERE changed {IN_WINDOW}"
_PAY_SCHEMA = "payment_oid bigint, amount double, operator string, changed ts"
_PAY_ALL = ObjectSpec("payment_state", "payment_oid", _PAY.fields)
add(
    "r03_keyed_merge",
    _PAY_SCHEMA,
    lambda c: R.merge_object(_pay_target(c), _pay_source(c), _PAY_ALL),
    merge_sql(_PAY_TARGET, _PAY_SOURCE, _PAY_ALL),
)
add(
    "r03_merge_latest_duplicate",
    _PAY_SCHEMA,
    lambda c: R.merge_upsert(
        _pay_target(c),
        union_arms(_pay_source(c), _pay_source(c).withColumn("changed", F.col("changed") + F.expr("INTERVAL 1 DAY")).withColumn("operator", F.lit("new"))),
        "payment_oid",
        on_duplicate="latest",
        latest_by=["changed"],
    ),
    merge_sql(
        _PAY_TARGET,
        f"SELECT payment_oid, amount, 'new' AS operator, changed + INTERVAL 1 DAY AS changed FROM ({_PAY_SOURCE}) AS s0",
        _PAY_ALL,
    ),
)
add(
    "r04_partial_update",
    _PAY_SCHEMA,
    lambda c: R.merge_object(_pay_target(c), _pay_source(c), _PAY),
    merge_sql(_PAY_TARGET, _PAY_SOURCE, _PAY),
)
_SNAP_SPEC = ObjectSpec(
    "balances", "contract_oid", {"contract_oid": "C", "balance_remaining": "B", "residual": "R"}, defaults={"balance_remaining": 0, "residual": 0}
)
add(
    "r05_merge_with_defaults",
    "contract_oid bigint, balance_remaining double, residual double",
    lambda c: R.merge_object(_snapshot(c, PREV_AS_OF), _snapshot(c, AS_OF), _SNAP_SPEC),
    merge_sql(f"SELECT * FROM {_snap_sql(PREV_AS_OF)} AS p", f"SELECT * FROM {_snap_sql(AS_OF)} AS n", _SNAP_SPEC),
)
add(
    "r06_load_modes",
    "mode string, comments bigint, entities bigint",
    lambda c: union_arms(
        *[
            P.changed_between(c.read("comment"), "last_change_datetime", w).groupBy(F.lit(m).alias("mode")).agg(
                F.count(F.lit(1)).alias("comments"), F.countDistinct("ref_oid").alias("entities")
            )
            for m, w in (("initial", None), ("incremental", NOTE_WINDOW))
        ]
    ),
    f"""SELECT 'initial' AS mode, COUNT(*) AS comments, COUNT(DISTINCT ref_oid) AS entities FROM lease_comment
        UNION ALL SELECT 'incremental', COUNT(*), COUNT(DISTINCT ref_oid) FROM lease_comment
        WHERE last_change_datetime BETWEEN {TS(NOTE_START)} AND {TS(NOTE_END)}""",
)


def _two_pulls(c: StarCatalog) -> DataFrame:
    """Two overlapping pulls merged one after the other: re-read rows change nothing."""
    target = _pay_rows(c).filter(F.col("changed") < ts(START))
    for watermark, until in ((START, MIDDLE), (MIDDLE, END)):
        pulled = R.incremental_pull(_pay_rows(c), "changed", watermark, timedelta(days=3), until)
        target = R.merge_object(target, pulled, _PAY_ALL)
    return target


add(
    "r07_overlapping_pull",
    _PAY_SCHEMA,
    _two_pulls,
    f"SELECT * FROM ({_PAY_ROWS}) AS r WHERE changed <= {TS(END)}",
)
add(
    "r08_schedule_rollup",
    "schedule_definition_oid bigint, invoiced_occurrences bigint, uninvoiced_occurrences bigint, total_amount_due double,"
    " total_tax_amount_due double, invoiced_total double, uninvoiced_total double, first_invoiced ts, next_date ts, next_amount double",
    lambda c: G.schedule_rollup(c.read("payment_stream"), c.read("payment_stream_contract_item")),
    """WITH occ AS (SELECT schedule_definition_oid AS sid, SUM(CASE WHEN is_invoiced = 1 THEN occurrences ELSE 0 END) AS i,
         SUM(CASE WHEN is_invoiced = 0 THEN occurrences ELSE 0 END) AS u, MIN(start_date) FILTER (WHERE is_invoiced = 1) AS f,
         MAX(start_date) FILTER (WHERE is_invoiced = 0) AS n FROM lease_payment_stream GROUP BY ALL),
       fine AS (SELECT p.schedule_definition_oid AS sid, p.payment_stream_oid, p.occurrences, p.is_invoiced, i.amount, i.on_stream_tax_amount AS tax,
         SUM(p.occurrences) * i.amount AS da, SUM(p.occurrences) * i.on_stream_tax_amount AS dt FROM lease_payment_stream AS p
         LEFT JOIN lease_payment_stream_contract_item AS i ON i.payment_stream_oid = p.payment_stream_oid
         GROUP BY p.schedule_definition_oid, p.payment_stream_oid, p.occurrences, p.is_invoiced, i.amount, i.on_stream_tax_amount)
       SELECT occ.sid AS schedule_definition_oid, MAX(occ.i) AS invoiced_occurrences, MAX(occ.u) AS uninvoiced_occurrences,
         SUM(fine.da) AS total_amount_due, SUM(fine.dt) AS total_tax_amount_due,
         SUM(CASE WHEN fine.is_invoiced = 1 THEN fine.da + fine.dt ELSE 0 END) AS invoiced_total,
         SUM(CASE WHEN fine.is_invoiced = 0 THEN fine.da + fine.dt ELSE 0 END) AS uninvoiced_total, MAX(occ.f) AS first_invoiced,
         MAX(occ.n) AS next_date, MAX(fine.amount) AS next_amount FROM occ JOIN fine ON fine.sid = occ.sid GROUP BY occ.sid""",
)
add(
    "r09_term_payments",
    "contract_term_oid bigint, occurrences bigint, invoiced bigint, uninvoiced bigint, first_payment ts, next_payment ts",
    lambda c: G.term_payments(c.read("payment_stream")).filter("invoiced_rows > 0 AND uninvoiced_rows > 0"),
    """WITH fine AS (SELECT contract_term_oid AS term, is_invoiced AS inv, last_change_datetime, last_change_operator, MIN(start_date) AS lo,
         MAX(start_date) AS hi, SUM(occurrences) AS n FROM lease_payment_stream WHERE contract_term_oid IS NOT NULL GROUP BY ALL)
       SELECT i.term AS contract_term_oid, i.n + u.n AS occurrences, i.n AS invoiced, u.n AS uninvoiced, i.lo AS first_payment, u.hi AS next_payment
       FROM (SELECT term, SUM(n) AS n, MIN(lo) AS lo FROM fine WHERE inv = 1 GROUP BY term) AS i
       JOIN (SELECT term, SUM(n) AS n, MIN(hi) AS hi FROM fine WHERE inv = 0 GROUP BY term) AS u ON u.term = i.term""",
)
add(
    "r10_due_buckets",
    "contract_oid bigint, current_due double, past_due double, misc_due double, total_due double, oldest_rent_due ts",
    lambda c: G.due_buckets(c.read("invoice_detail"), c.read("invoice_header"), c.read("transaction_code"), AS_OF, how="min"),
    f"""SELECT d.contract_oid, SUM(CASE WHEN d.transaction_code_oid IN (1, 35, 4) AND d.due_date >= {TS(AS_OF)} THEN d.current_due_amount END) AS current_due,
          SUM(CASE WHEN d.transaction_code_oid IN (1, 35, 4) AND d.due_date < {TS(AS_OF)} THEN d.current_due_amount END) AS past_due,
          SUM(CASE WHEN d.transaction_code_oid NOT IN (1, 35, 4) THEN d.current_due_amount END) AS misc_due, SUM(d.current_due_amount) AS total_due,
          MIN(CASE WHEN d.transaction_code_oid IN (1, 35) THEN d.due_date END) AS oldest_rent_due
        FROM lease_invoice_detail AS d JOIN lease_invoice_header AS h ON h.invoice_header_oid = d.invoice_header_oid AND h.is_posted = 1
        JOIN lease_transaction_code AS t ON t.transaction_code_oid = d.transaction_code_oid
        WHERE d.open_closed_oid NOT IN (11022, 11023) AND d.current_due_amount <> 0 GROUP BY d.contract_oid""",
)

# --- streaming ----------------------------------------------------------------------------

_EVENT = ObjectSpec(
    "user_state", "user_id", {"user_id": "User__c", "event_id": "Event__c", "event_type": "Type__c", "value": "Value__c", "ts": "Changed__c"}
)
_EVENT_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


_STATE_DDL = "user_id bigint, event_id bigint, event_type string, value double, ts timestamp_ntz"


def _streamed(c: StarCatalog, source: str, files_per_trigger: int | None = None, merge: bool = False) -> DataFrame:
    """Change files consumed as a stream and merged by user."""
    target, order = scratch_path(c.spark, "stream-target"), ["ts", "event_id"]
    empty_target(c.spark, target, _STATE_DDL, "user_id", 4)
    stream = change_stream(c.spark, source, _EVENT_DDL, files_per_trigger)
    query = stream_upsert(stream, _EVENT, "ts", target, scratch_path(c.spark, "stream-checkpoint"), tie_breakers=["event_id"])
    query.awaitTermination()
    if merge:
        R.compact(c.spark, target, _EVENT, order)
        return c.spark.read.schema(_STATE_DDL).parquet(target).select(*_EVENT.columns)
    return R.keyed_state(c.spark, target, _EVENT, _STATE_DDL, order)


def _late_files(c: StarCatalog) -> DataFrame:
    """The events in four files, the newest first, so that most rows come days late; then merged into the target."""
    folder = scratch_path(c.spark, "stream-late")
    days = c.spark.read.schema(_EVENT_DDL).parquet(f"{c.root}/events*.parquet").withColumn("turn", F.pmod(F.datediff(F.lit("2030-01-01"), "ts"), F.lit(4)))
    for turn in range(4):  # one micro-batch each
        days.filter(F.col("turn") == turn).drop("turn").coalesce(1).write.parquet(f"{folder}/f{turn}")
    return _streamed(c, f"{folder}/*", files_per_trigger=1, merge=True)


_LATEST_EVENT = """SELECT user_id, event_id, event_type, value, ts FROM events
       QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
add("t01_stream_late_files", "user_id bigint, event_id bigint, event_type string, value double, ts ts", _late_files, _LATEST_EVENT)


def _bucketed(c: StarCatalog) -> DataFrame:
    """The keyed merge through a bucketed folder."""
    path = scratch_path(c.spark, "bucketed")
    R.write_keyed(_pay_target(c), path, "payment_oid", 8)
    R.upsert_into_path(c.spark, path, _pay_source(c), _PAY_ALL)
    return c.spark.read.parquet(path).drop("bucket")


add("r03_bucketed_upsert", _PAY_SCHEMA, _bucketed, merge_sql(_PAY_TARGET, _PAY_SOURCE, _PAY_ALL))
add(
    "t01_stream_upsert",
    "user_id bigint, event_id bigint, event_type string, value double, ts ts",
    lambda c: _streamed(c, f"{c.root}/events*.parquet"),
    _LATEST_EVENT,
)

__all__ = ["operators"]
