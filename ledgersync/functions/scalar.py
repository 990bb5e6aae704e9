"""Column expressions of the ledger extracts, all built in (no Python UDF)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgersync.functions.clock import as_datetime, ts

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default(x: ColumnLike, value: Any) -> Column:
    """``value`` where ``x`` is NULL."""
    return F.coalesce(_col(x), value if isinstance(value, Column) else F.lit(value))


def is_blank(x: ColumnLike) -> Column:
    """Empty or only blanks (trailing blanks do not count in the ledger's comparisons)."""
    return F.rtrim(_col(x)) == ""


def mask_tail(x: ColumnLike, keep: int = 4, ch: str = "x") -> Column:
    """Hide all but the last ``keep`` characters.

    Shorter numbers are hidden whole, exactly ``keep`` characters stay readable
    and an empty number becomes NULL.
    """
    c = _col(x)
    n = F.length(F.rtrim(c))
    hidden = F.when(n < keep, n).otherwise(n - keep)
    return F.when(F.length(c) > 0, F.concat(F.repeat(F.lit(ch), hidden), F.substr(c, hidden + 1)))


def join_address(lines: Sequence[ColumnLike], city: ColumnLike, state: ColumnLike) -> Column:
    """``line, line, city, state``; blank lines are left out."""
    parts = [F.when(~is_blank(c), F.concat(_col(c), F.lit(", "))) for c in lines]
    return F.concat_ws("", *parts, _col(city), F.lit(", "), _col(state))


def full_address(line1: ColumnLike, line2: ColumnLike, city: ColumnLike, state: ColumnLike, postal: ColumnLike) -> Column:
    """``line1line2, city, state postal``; NULL parts count as empty."""
    sep = F.lit(", ")
    return F.concat_ws("", _col(line1), _col(line2), sep, _col(city), sep, _col(state), F.lit(" "), _col(postal))


def party_name(kind: ColumnLike, name: ColumnLike, *person_parts: ColumnLike) -> Column:
    """A business' trimmed name, or the person's non-blank name parts single spaced."""
    parts = [F.nullif(F.trim(_col(p)), F.lit("")) for p in person_parts]
    return F.when(_col(kind) == "B", F.trim(_col(name))).otherwise(F.concat_ws(" ", *parts))


def composite_key(*cols: ColumnLike, sep: str = "") -> Column:
    """Text key over several columns; without ``sep`` different keys can collide."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def prefix(x: ColumnLike, n: int) -> Column:
    return F.substring(_col(x), 1, n)


def memo(kind: ColumnLike, contract_id: ColumnLike, name: ColumnLike, transaction: ColumnLike) -> Column:
    """Journal memo line; NULL when any part is NULL."""
    return F.concat(_col(kind), F.lit(" #"), _col(contract_id), F.lit(" "), _col(name), F.lit(" - "), _col(transaction))


def classify(x: ColumnLike, mapping: Mapping[Any, Any], otherwise: Any = None, *, null: Any = None) -> Column:
    """Label by code: a mapping key is one code or a tuple of codes; first hit wins."""
    c = _col(x)
    chain = F.when(c.isNull(), F.lit(null))
    for codes, label in mapping.items():
        group = codes if isinstance(codes, tuple) else (codes,)
        chain = chain.when(c.isin(*group), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def classify_contract(contract_id: ColumnLike) -> Column:
    """Contract type from the letter in the contract id."""
    c = _col(contract_id)
    return F.when(c.contains("R"), "Rebook").when(c.contains("E"), "EFA").otherwise("Lease")


# Process codes per journal.
JOURNAL_TYPES = {
    20119: "BKJ",
    (20120, 20121): "ASBJ",
    (20122, 20135, 20134): "ACRJ",
    20123: "ABAJ",
    (20126, 20127): "AMJ",
    (20140, 20141): "CMJ",
    20128: "ACJ",
    20143: "DPJ",
}

# Disposal codes are their own labels.
DISPOSAL_TYPES = {"Sale": "Sale", "Inventory": "Inventory", "Abandon": "Abandon"}

# Export account moved by the sign of the net, or by the termination reason.
RECLASS_ACCOUNT = "42001"
RECLASS_NOT_CREDIT = "14000"
RECLASS_BY_REASON = "42002"
RECLASS_REASONS = ("I", "CO")


def disposal_label(x: ColumnLike) -> Column:
    return classify(x, DISPOSAL_TYPES, "ERROR", null="Not Disposed")


def split_debit(net: ColumnLike) -> Column:
    n = _col(net)
    return F.when(n >= 0, n)


def split_credit(net: ColumnLike) -> Column:
    n = _col(net)
    return F.when(n < 0, -n)


def reclass(account: ColumnLike, net: ColumnLike, debit: ColumnLike, reason: ColumnLike) -> Column:
    """Export account after the two reclassification rules (first match wins)."""
    acc, hit = _col(account), _col(account) == RECLASS_ACCOUNT
    by_reason = hit & _col(reason).isin(*RECLASS_REASONS) & (F.coalesce(_col(debit), F.lit(0)) == 0)
    return F.when(hit & split_credit(net).isNull(), RECLASS_NOT_CREDIT).when(by_reason, RECLASS_BY_REASON).otherwise(acc)


def days_past_due(due: ColumnLike, reference: ColumnLike) -> Column:
    """Midnights between the oldest due date and the reference time, never negative."""
    days = F.datediff(_col(reference), _col(due))
    return F.when(days < 0, 0).otherwise(days)


def _seconds_of_day(c: Column) -> Column:
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c)


def days_between_rounded(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Elapsed days rounded to the nearest whole day (a noon difference rounds up)."""
    a, b = _col(later), _col(earlier)
    seconds = F.datediff(a, b) * 86400 + _seconds_of_day(a) - _seconds_of_day(b)
    return F.floor(seconds / 86400 + F.lit(0.5).cast("decimal(2,1)")).cast("int")


def us_date(x: ColumnLike) -> Column:
    """``MM/dd/yyyy`` text."""
    return F.date_format(_col(x), "MM/dd/yyyy")


def next_due_date(first_unbilled: ColumnLike, first_billed: ColumnLike, as_of: str | datetime, terminated: ColumnLike) -> Column:
    """Next due date rolled from the first unbilled date into this month or the next.

    A due day that the target month lacks gives NULL instead of an error.
    """
    now = as_datetime(as_of)
    due, day = _col(first_unbilled), F.dayofmonth(_col(first_unbilled))

    def on_day(year: int, month: int) -> Column:
        first = F.lit(f"{year:04d}-{month:02d}-01").cast("date")
        return F.when(day <= F.dayofmonth(F.last_day(first)), F.date_add(first, day - 1))

    open_now = (due <= ts(now)) & (_col(terminated) == 0)
    this_month = on_day(now.year, now.month)
    return (
        F.when(due > ts(now), F.to_date(_col(first_billed)))
        .when(open_now & (day > now.day) & (F.month(due) == 12), F.add_months(on_day(now.year + 1, 1), 1))
        .when(open_now & (day > now.day), this_month)
        .when(open_now & (day < now.day), F.add_months(this_month, 1))
    )


def latest_of(cols: Sequence[ColumnLike], payloads: Sequence[ColumnLike] | None = None) -> Column:
    """Greatest of several times, or the payload that belongs to it.

    A NULL never wins a comparison, so any NULL falls through to the last column.
    """
    times = [_col(c) for c in cols]
    values = [_col(p) for p in (payloads or cols)]
    chain: Column | None = None
    for i, t in enumerate(times[:-1]):
        wins = reduce(lambda a, b: a & b, [t >= o for j, o in enumerate(times) if j != i])
        chain = F.when(wins, values[i]) if chain is None else chain.when(wins, values[i])
    return values[-1] if chain is None else chain.otherwise(values[-1])


def net_investment(
    balance: ColumnLike,
    unearned: ColumnLike,
    residual: ColumnLike,
    deferred_residual: ColumnLike,
    deferred_expense: ColumnLike,
    deposit: ColumnLike,
    *,
    at_termination: bool = False,
) -> Column:
    """Book value of a contract; a missing balance makes it 0.

    At termination every term defaults to 0 and the sign flips.
    """

    def z(c: ColumnLike) -> Column:
        return F.coalesce(_col(c), F.lit(0))

    adds, subs = z(residual) + z(deferred_expense), z(unearned) + z(deferred_residual) + z(deposit)
    if at_termination:
        return -(z(balance) + adds - subs)
    return F.coalesce(_col(balance) + adds - subs, F.lit(0))


def blank_when(cond: Column, x: ColumnLike, value: Any = None) -> Column:
    """``value`` where ``cond`` holds, else ``x``."""
    return F.when(cond, value if isinstance(value, Column) else F.lit(value)).otherwise(_col(x))


def rate_text(rate: ColumnLike, suffix: str = "") -> Column:
    """A rate as percentage text with its eight decimals."""
    text = (_col(rate).cast("decimal(18,8)") * F.lit(100)).cast("decimal(22,8)").cast("string")
    return F.concat(text, F.lit(suffix)) if suffix else text
