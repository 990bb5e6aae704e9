"""Row filters of the extracts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.functions.clock import Window, ts
from ledgersync.functions.scalar import ColumnLike, _col


def project(df: DataFrame, mapping: Mapping[str, Any], *, with_id: bool = False) -> DataFrame:
    """Target columns from columns, names or plain values; ``with_id`` adds the empty record id."""
    cols = [F.lit(None).cast("string").alias("id")] if with_id else []
    for name, value in mapping.items():
        cols.append((value if isinstance(value, Column) else F.lit(value)).alias(name))
    return df.select(*cols)


def contract_scope(df: DataFrame, booked: int = 1, company: int = 1, terminated: int | None = None) -> DataFrame:
    """Booked contracts of one company; optionally only active (0) or terminated (1) ones."""
    out = df.filter((F.col("is_booked") == booked) & (F.col("company_oid") == company))
    return out if terminated is None else out.filter(F.col("is_terminated") == terminated)


def changed_between_any(df: DataFrame, cols: Iterable[ColumnLike], window: Window | None) -> DataFrame:
    """Rows where any change time lies in the closed window; no window keeps all rows."""
    if window is None:
        return df
    start, end = ts(window.start), ts(window.end)
    return df.filter(reduce(lambda a, b: a | b, [_col(c).between(start, end) for c in cols]))


def changed_between(df: DataFrame, col: ColumnLike, window: Window | None) -> DataFrame:
    return changed_between_any(df, [col], window)


def in_codes(col: ColumnLike, codes: Iterable[Any], negate: bool = False) -> Column:
    """Membership in a code set; a NULL code is in neither the set nor its complement."""
    hit = _col(col).isin(*codes)
    return ~hit if negate else hit


def contains(col: ColumnLike, text: str, negate: bool = False, ignore_case: bool = False) -> Column:
    c = _col(col)
    hit = F.lower(c).contains(text.lower()) if ignore_case else c.contains(text)
    return ~hit if negate else hit


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where every named column is present."""
    return df.dropna(subset=list(cols))


def in_month(col: ColumnLike, day: str | date | datetime) -> Column:
    """Posted in the month of ``day``, by month-end dates taken at midnight.

    Rows stamped later on the last day fall out, rows stamped later on the
    previous month's last day fall in.
    """
    d = ts(day)
    upper = F.last_day(d).cast("timestamp_ntz")
    lower = F.last_day(F.add_months(d, -1)).cast("timestamp_ntz")
    return (_col(col) > lower) & (_col(col) <= upper)


def row_predicate(cond: Column, key: ColumnLike, scope: str = "row") -> Column:
    """``cond`` on a row with a key, or (``scope='group'``) on any row of the same key.

    The group form is a window over the key; use ``flag_groups`` where one key may
    hold a large part of the rows.
    """
    hit = F.coalesce(cond, F.lit(False)) & _col(key).isNotNull()
    if scope == "row":
        return hit
    if scope == "group":
        return F.max(hit).over(W.partitionBy(_col(key)))
    raise ValueError(f"unknown scope {scope!r}")


def flag_groups(df: DataFrame, cond: Column, key: str, name: str) -> DataFrame:
    """Mark every row whose key has a row meeting ``cond`` (keys pre-aggregated, skew safe)."""
    keys = df.filter(cond & F.col(key).isNotNull()).select(key).distinct().withColumn(name, F.lit(True))
    return df.join(keys, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def exclude(df: DataFrame, cond: Column) -> DataFrame:
    """Rows for which ``cond`` is false; rows where it is unknown go too."""
    return df.filter(~cond)
