"""Grouped measures. Every sum is taken map-side first, so hot keys shuffle little."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.functions.clock import ts
from ledgersync.functions.scalar import split_credit, split_debit

# Ledger accounts and processes of the contract balances.
GROSS_ACCOUNT = "01-10089"
BALANCE_ACCOUNTS = ("01-10089", "01-10090")
RESIDUAL_ACCOUNT = "01-10091"
UNEARNED_ACCOUNT = "01-10092"
DEFERRED_RESIDUAL_ACCOUNT = "01-10093"
DEFERRED_EXPENSE_ACCOUNT = "01-10094"
DEPOSIT_ACCOUNT = "01-10130"
GROSS_PROCESSES = (20119, 20126, 20127, 20140, 20141, 20143)
ORIGINAL_GROSS_PROCESSES = (20119, 20126, 20127, 20140)
TERMINATION_GROSS_PROCESSES = (20119, 20126, 20127, 20140, 20141)
NARROW_GROSS_PROCESSES = (20119, 20126, 20127)
TERMINATION_PROCESS = 20143

# Rent transaction codes and open/closed states of the days-past-due rule.
RENT_CODES = (1, 35, 25, 37, 43)
CLOSED_STATES = (11022, 11023)
TERMINATED_EXCLUDED_STATES = (11020, 11021, 11024, 11025)

# Codes of the receivable status sums.
DUE_RENT_CODES = (1, 35)
DUE_RENT_AND_TAX_CODES = (1, 35, 4)


def _codes(values: Sequence[int | str]) -> str:
    """Code list as SQL text."""
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


@dataclass(frozen=True)
class Bucket:
    """One conditional sum: rows meeting ``when`` (an SQL condition) add ``sign`` times the amount.

    Without a qualifying row the sum is NULL, or ``default`` if given. ``accounts`` and
    ``processes`` name every account and process that ``when`` tells apart (none: it asks
    for no such code); a bucket that doesn't say may use any.
    """

    name: str
    when: str
    sign: int = 1
    default: int | None = None
    accounts: tuple[str, ...] | None = None
    processes: tuple[int, ...] | None = None

    def total(self, amount: str) -> Column:
        text = f"SUM(CASE WHEN {self.when} THEN {'-' if self.sign < 0 else ''}({amount}) END)"
        return F.expr(f"{text if self.default is None else f'COALESCE({text}, {self.default})'} AS {self.name}")


def _named(named: Sequence[tuple | None]) -> list | None:
    """The codes that some bucket tells apart; None where a bucket doesn't say."""
    return None if any(n is None for n in named) else sorted({c for n in named for c in n})


def _literals(values: Sequence[int | str]) -> list[str]:
    return [f"'{v}'" if isinstance(v, str) else f"{v}L" for v in values]


def _packed(places: Mapping[str, tuple[str, list[str], str]]) -> tuple[Column, list[Column]]:
    """Several columns of few values as one number ``__cell``, and the columns it stands for.

    ``places`` gives a column's SQL expression, its values as SQL text and their type; any other value, NULL too, is NULL.
    """
    cell, unpacked, below = "0L", [], math.prod(len(values) + 1 for _, values, _ in places.values())
    for name, (text, values, kind) in places.items():
        below, n = below // (len(values) + 1), len(values) + 1
        if values:
            place = "0L"
            for i, v in enumerate(values, 1):
                place = f"IF({text} = {v}, {i * below}L, {place})"
            cell += f" + {place}"
        known = ", ".join([f"CAST(NULL AS {kind})", *values])
        unpacked.append(F.expr(f"element_at(array({known}), CAST(__cell DIV {below} % {n} + 1 AS INT)) AS {name}"))
    return F.expr(f"{cell} AS __cell"), unpacked


# Debit plus credit (credits are stored negative).
LEDGER_AMOUNT = "COALESCE(debit, 0) + COALESCE(credit, 0)"


def bucket_sums(df: DataFrame, keys: Sequence[str], amount: str, buckets: Sequence[Bucket], *extra: Column) -> DataFrame:
    """All buckets in one pass over ``df``; ``amount`` is an SQL expression."""
    return df.groupBy(*keys).agg(*[b.total(amount) for b in buckets], *extra)


def _balance_terms(prefix: str, cond: str, processes: tuple[int, ...] = ()) -> list[Bucket]:
    def term(name: str, accounts: tuple[str, ...], sign: int = 1) -> Bucket:
        return Bucket(f"{prefix}{name}", f"{cond} AND account_id IN ({_codes(accounts)})", sign, None, accounts, processes)

    return [
        term("balance_remaining", BALANCE_ACCOUNTS),
        term("unearned_finance", (UNEARNED_ACCOUNT,), -1),
        term("residual", (RESIDUAL_ACCOUNT,)),
        term("deferred_residual", (DEFERRED_RESIDUAL_ACCOUNT,), -1),
        term("deferred_expense", (DEFERRED_EXPENSE_ACCOUNT,)),
        term("security_deposit", (DEPOSIT_ACCOUNT,), -1),
    ]


def gross_bucket(name: str, processes: Sequence[int], cond: str = "TRUE", default: int | None = None) -> Bucket:
    """Gross receivable under one process list."""
    when = f"{cond} AND account_id = '{GROSS_ACCOUNT}' AND process_oid IN ({_codes(processes)})"
    return Bucket(name, when, default=default, accounts=(GROSS_ACCOUNT,), processes=tuple(processes))


def snapshot_buckets(posted: str = "TRUE") -> list[Bucket]:
    """The contract balances from rows meeting ``posted``."""
    return [
        gross_bucket("gross_receivable", GROSS_PROCESSES, posted),
        gross_bucket("original_gross_receivable", ORIGINAL_GROSS_PROCESSES, posted),
        *_balance_terms("", posted),
    ]


def termination_buckets() -> list[Bucket]:
    """Balances moved by the termination process, and gross before it; no date limit."""
    return [
        gross_bucket("term_gross_receivable", TERMINATION_GROSS_PROCESSES),
        *_balance_terms("term_", f"process_oid = {TERMINATION_PROCESS}", (TERMINATION_PROCESS,)),
    ]


def ledger_buckets(
    gl: DataFrame,
    account_ids: DataFrame,
    buckets: Sequence[Bucket],
    flags: Mapping[str, str] | None = None,
    counts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Bucket sums per contract from one ledger scan.

    The ledger is first reduced to one amount per account id, account, process and
    flag (named SQL conditions such as posted-by-date); only that narrow table is
    shuffled, meets the account table and is spread over the buckets. Bucket
    conditions may use ``account_id``, ``process_oid`` and the flags. ``counts``
    adds row counts under the given conditions.
    """
    flags, counts = flags or {}, counts or {}
    # Accounts and processes outside every bucket become NULL, so that their rows fall together; what is told apart travels as one number.
    codes = {"account_id": _named([b.accounts for b in buckets]), "process_oid": _named([b.processes for b in buckets])}
    places = {n: (n, _literals(values), "BIGINT" if n == "process_oid" and values else "STRING") for n, values in codes.items() if values is not None}
    cell, unpacked = _packed(places | {n: (f"({c})", ["FALSE", "TRUE"], "BOOLEAN") for n, c in flags.items()})
    told = [n for n, values in codes.items() if values is None]
    reduced = gl.groupBy("general_ledger_account_id_oid", cell, *told).agg(
        F.expr(f"SUM({LEDGER_AMOUNT}) AS amount"), F.expr("COUNT(1) AS ledger_rows")
    )
    return spread_buckets(reduced, account_ids, buckets, counts, unpacked)


def contracts_of(account_ids: DataFrame) -> DataFrame:
    """(account id, contract) of the account ids that belong to a contract."""
    return account_ids.select("general_ledger_account_id_oid", "contract_oid").filter("contract_oid IS NOT NULL")


def spread_buckets(
    reduced: DataFrame, account_ids: DataFrame, buckets: Sequence[Bucket], counts: Mapping[str, str] | None = None, unpacked: Sequence[Column] = ()
) -> DataFrame:
    """Bucket sums per contract from a ledger already reduced to amounts per account id, account, process and flags.

    ``unpacked`` are columns made of the reduced ones once the rows lie by contract.
    """
    joined = reduced.join(contracts_of(account_ids), "general_ledger_account_id_oid").drop("general_ledger_account_id_oid")
    # Laid out by contract as the narrow rows they are: they are reduced already, and partial sums would send every bucket of each.
    joined = joined.repartition("contract_oid").select("*", *unpacked)
    row_counts = [F.expr(f"COALESCE(SUM(CASE WHEN {c} THEN ledger_rows END), 0) AS {n}") for n, c in (counts or {}).items()]
    return bucket_sums(joined, ["contract_oid"], "amount", buckets, *row_counts)


def ledger_snapshot(gl: DataFrame, account_ids: DataFrame, as_of: str | datetime) -> DataFrame:
    """Contract balances from rows posted up to ``as_of``."""
    out = ledger_buckets(gl.filter(F.col("post_date") <= ts(as_of)), account_ids, snapshot_buckets())
    return out.withColumn("original_gross_receivable", F.coalesce("original_gross_receivable", F.lit(0)))


def regroup(
    df: DataFrame,
    inner_keys: Sequence[str],
    inner_aggs: Sequence[Column],
    outer_keys: Sequence[str],
    outer_aggs: Sequence[Column],
) -> DataFrame:
    """Group finely, then group the result again."""
    return df.groupBy(*inner_keys).agg(*inner_aggs).groupBy(*outer_keys).agg(*outer_aggs)


def count_flag(df: DataFrame, keys: Sequence[str], flag: str, name: str, only_set: bool = False) -> DataFrame:
    """Rows that carry a flag at all; ``only_set`` counts those whose flag is 1."""
    counted = F.when(F.col(flag) == 1, 1) if only_set else F.col(flag)
    return df.groupBy(*keys).agg(F.count(counted).alias(name))


def split_sums(df: DataFrame, keys: Sequence[str], value: str, flag: str, names: tuple[str, str]) -> DataFrame:
    """Totals where the flag is 1 and where it is 0, each 0 without rows."""

    def total(v: int, name: str) -> Column:
        return F.sum(F.when(F.col(flag) == v, F.col(value)).otherwise(0)).alias(name)

    return df.groupBy(*keys).agg(total(1, names[0]), total(0, names[1]))


def sign_split(df: DataFrame, net: str, debit: str = "debit", credit: str = "credit") -> DataFrame:
    """A net amount as debit (>= 0) or positive credit (< 0), the other side NULL."""
    return df.withColumn(debit, split_debit(net)).withColumn(credit, split_credit(net))


def oldest_unpaid_by(
    details: DataFrame,
    payments: DataFrame,
    as_of: str | datetime,
    due_excluded: Mapping[str, Sequence[int]],
    codes: Sequence[int] = RENT_CODES,
    paid_excluded: Sequence[int] = CLOSED_STATES,
) -> DataFrame:
    """Oldest due date per contract among invoices not fully paid, under several state rules at once.

    ``due_excluded`` names an output column per list of invoice states that do not
    count as due. Lines and payments are read once for all rules.
    """
    now, state = ts(as_of), F.col("open_closed_oid")
    paid = (
        payments.filter(F.col("applied_date") <= now).groupBy("invoice_detail_oid").agg(F.sum("applied_amount").alias("paid"))
    )
    d = details.filter((F.col("due_date") <= now) & F.col("transaction_code_oid").isin(*codes) & state.isNotNull())
    # Laid out by invoice as the narrow rows they are: the lines of an invoice are few, and its dates meet again in the window.
    lines = d.join(paid, "invoice_detail_oid", "left")
    lines = lines.select("contract_oid", "invoice_header_oid", "due_date", "open_closed_oid", "original_due_amount", "paid")
    per_date = (
        lines.repartition("contract_oid", "invoice_header_oid")
        .groupBy("contract_oid", "invoice_header_oid", "due_date")
        .agg(
            F.sum(F.when(~state.isin(*paid_excluded), F.col("paid"))).alias("paid"),
            *[F.sum(F.when(~state.isin(*states), F.col("original_due_amount"))).alias(n) for n, states in due_excluded.items()],
        )
    )
    # One row per due date is left, so the window holds few rows even for a hot header.
    header = W.partitionBy("contract_oid", "invoice_header_oid")
    open_dates = per_date.withColumn("header_paid", F.coalesce(F.sum("paid").over(header), F.lit(0)))
    # No qualifying line leaves the due sum NULL, which is never above the payments.
    oldest = [F.min(F.when(F.col(n) > F.col("header_paid"), F.col("due_date"))).alias(n) for n in due_excluded]
    return open_dates.groupBy("contract_oid").agg(*oldest)


def oldest_unpaid(
    details: DataFrame,
    payments: DataFrame,
    as_of: str | datetime,
    codes: Sequence[int] = RENT_CODES,
    due_excluded: Sequence[int] = CLOSED_STATES,
    paid_excluded: Sequence[int] = CLOSED_STATES,
) -> DataFrame:
    """Oldest due date per contract among invoices not fully paid at ``as_of``."""
    out = oldest_unpaid_by(details, payments, as_of, {"oldest_due": due_excluded}, codes, paid_excluded)
    return out.filter(F.col("oldest_due").isNotNull())


def invoice_settlement(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Applied total and last post date per invoice line (returned payments left out)."""
    paid = (
        payments.filter((F.col("is_returned") == 0) & F.col("invoice_detail_oid").isNotNull())
        .groupBy("invoice_detail_oid")
        .agg(F.sum("applied_amount").alias("total_applied_amount"), F.to_date(F.max("post_date")).alias("pay_in_full_date"))
    )
    return invoices.join(paid, "invoice_detail_oid", "left")


def due_buckets(details: DataFrame, headers: DataFrame, codes: DataFrame, as_of: str | datetime, how: str = "max") -> DataFrame:
    """Receivable status per contract in one pass over the open invoice lines.

    ``how`` picks which due date counts as the oldest rent due (``max`` is the
    delivered behaviour, ``min`` the literal reading of the name).
    """
    now, due, code = ts(as_of), F.col("current_due_amount"), F.col("transaction_code_oid")
    posted = headers.filter(F.col("is_posted") == 1).select("invoice_header_oid")
    open_lines = details.filter(~F.col("open_closed_oid").isin(*CLOSED_STATES) & (due != 0))
    known = open_lines.join(codes.select("transaction_code_oid"), "transaction_code_oid", "left_semi").join(
        posted, "invoice_header_oid", "left_semi"
    )
    rent, rent_tax = code.isin(*DUE_RENT_CODES), code.isin(*DUE_RENT_AND_TAX_CODES)
    pick = F.max if how == "max" else F.min
    return known.groupBy("contract_oid").agg(
        F.sum(F.when(rent_tax & (F.col("due_date") >= now), due)).alias("current_due"),
        F.sum(F.when(rent_tax & (F.col("due_date") < now), due)).alias("past_due"),
        F.sum(F.when(~rent_tax, due)).alias("misc_due"),
        F.sum(due).alias("total_due"),
        pick(F.when(rent, F.col("due_date"))).alias("oldest_rent_due"),
        F.max(F.when(rent, F.col("due_date"))).alias("latest_rent_due"),
    )


def _item_totals(items: DataFrame) -> DataFrame:
    """Amounts of the items of a payment stream, one row per stream."""
    both = F.col("amount") + F.col("on_stream_tax_amount")
    # Laid out by stream as the narrow rows they are: a stream has few items, and partial sums of them would be wider rows.
    items = items.select("payment_stream_oid", "amount", "on_stream_tax_amount", "last_change_datetime").repartition("payment_stream_oid")
    return items.groupBy("payment_stream_oid").agg(
        F.sum("amount").alias("item_amount"),
        F.sum("on_stream_tax_amount").alias("item_tax"),
        F.sum(both).alias("item_both"),
        F.max("amount").alias("item_max_amount"),
        F.max("on_stream_tax_amount").alias("item_max_tax"),
        F.max("last_change_datetime").alias("item_change"),
    )


def schedule_rollup(streams: DataFrame, items: DataFrame, frequencies: DataFrame | None = None) -> DataFrame:
    """Totals, invoiced split, dates, next payment and change times per schedule.

    Items are reduced to one row per stream before they meet the streams, so
    occurrences are never multiplied and one pass yields every figure.
    ``frequencies`` (``data_value``, ``descr``) adds the frequency label.
    """
    s = streams.filter(F.col("schedule_definition_oid").isNotNull()).join(_item_totals(items), "payment_stream_oid", "left")
    if frequencies is None:
        s = s.withColumn("__label", F.lit(None).cast("int"))
    else:
        # the greatest label by its place among the few labels: a text maximum would force a sorted aggregation
        place = F.dense_rank().over(W.orderBy("frequency_label"))
        labels = frequencies.select(F.col("data_value").alias("frequency"), F.col("descr").alias("frequency_label"))
        labels = labels.dropna().withColumn("__label", place)
        s = s.join(labels.select("frequency", "__label"), "frequency", "left")
    occ, inv, start = F.col("occurrences"), F.col("is_invoiced") == 1, F.col("start_date")
    uninv, both = F.col("is_invoiced") == 0, F.col("occurrences") * F.col("item_both")
    stream_change, item_change = F.col("last_change_datetime"), F.col("item_change")
    complete = stream_change.isNotNull() & item_change.isNotNull()
    # The streams of a schedule are few and lie apart, so partial sums would be as many rows, with every figure of each.
    s = s.repartition("schedule_definition_oid")
    out = s.groupBy("schedule_definition_oid").agg(
        F.min(F.when(inv, start)).alias("first_invoiced"),
        F.max(F.when(uninv, start)).alias("next_date"),
        F.sum(F.when(inv, occ).otherwise(0)).alias("invoiced_occurrences"),
        F.sum(F.when(uninv, occ).otherwise(0)).alias("uninvoiced_occurrences"),
        F.max("item_max_amount").alias("next_amount"),
        F.max("item_max_tax").alias("next_tax"),
        F.sum(occ * F.col("item_amount")).alias("total_amount_due"),
        F.sum(occ * F.col("item_tax")).alias("total_tax_amount_due"),
        F.sum(F.when(inv, both).otherwise(0)).alias("invoiced_total"),
        F.sum(F.when(uninv, both).otherwise(0)).alias("uninvoiced_total"),
        F.max("__label").alias("__label"),
        F.max(F.when(complete, F.greatest(stream_change, item_change))).alias("full_change"),
        F.max(F.when(stream_change.isNull(), item_change)).alias("item_only_change"),
        F.max(item_change).alias("item_change"),
    )
    if frequencies is None:
        return out.withColumn("frequency_label", F.lit(None).cast("string")).drop("__label")
    return out.join(labels.select("__label", "frequency_label").distinct(), "__label", "left").drop("__label")


def term_payments(streams: DataFrame) -> DataFrame:
    """Occurrences and first/next dates per contract term, from one scan.

    The next date is the least over change groups of the latest un-invoiced
    start, hence the two levels. ``invoiced_rows``/``uninvoiced_rows`` tell which
    sides a term has.
    """
    inv, uninv = F.col("is_invoiced") == 1, F.col("is_invoiced") == 0
    start, occ = F.col("start_date"), F.col("occurrences")
    has_inv = F.col("invoiced_rows") > 0
    return regroup(
        streams.filter(F.col("contract_term_oid").isNotNull()),
        ["contract_term_oid", "last_change_datetime", "last_change_operator"],
        [
            F.sum(occ).alias("occurrences"),
            F.sum(F.when(inv, occ)).alias("invoiced"),
            F.sum(F.when(uninv, occ)).alias("uninvoiced"),
            F.min(F.when(inv, start)).alias("first_payment"),
            F.max(F.when(uninv, start)).alias("next_payment"),
            F.count(F.when(inv, 1)).alias("invoiced_rows"),
            F.count(F.when(uninv, 1)).alias("uninvoiced_rows"),
        ],
        ["contract_term_oid"],
        [
            F.sum("occurrences").alias("occurrences"),
            F.sum("invoiced").alias("invoiced"),
            F.sum("uninvoiced").alias("uninvoiced"),
            F.min("first_payment").alias("first_payment"),
            F.min("next_payment").alias("next_payment"),
            F.max(F.when(has_inv, F.col("last_change_datetime"))).alias("last_change_datetime"),
            F.max(F.when(has_inv, F.col("last_change_operator"))).alias("last_change_operator"),
            F.sum("invoiced_rows").alias("invoiced_rows"),
            F.sum("uninvoiced_rows").alias("uninvoiced_rows"),
        ],
    )
