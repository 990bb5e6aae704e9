"""Explicit clocks: every time-dependent result takes ``as_of`` as a parameter."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lookback of each polled object.
LOOKBACK = {
    "contract": timedelta(minutes=60),
    "collector": timedelta(minutes=60),
    "invoice": timedelta(hours=1),
    "payment": timedelta(hours=1),
    "scheduled_billables": timedelta(hours=1),
    "total_payments": timedelta(hours=1),
    "equipment": timedelta(hours=1),
    "eft_alt_schedule": timedelta(hours=1),
    "invoice_header": timedelta(hours=1),
    "payment_key": timedelta(hours=1),
    "notes": timedelta(days=1),
    "eft_assignment": timedelta(days=1),
}


def as_datetime(value: str | date | datetime) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def ts(value: str | date | datetime) -> Column:
    """Zone-less timestamp literal (folds to a constant, so filters still push down)."""
    return F.expr(ts_sql(value))


def ts_sql(value: str | date | datetime) -> str:
    """The same literal as SQL text."""
    return f"TIMESTAMP_NTZ'{as_datetime(value).isoformat(sep=' ')}'"


@dataclass(frozen=True)
class Window:
    """Closed change window ``[start, end]``."""

    start: datetime
    end: datetime

    @classmethod
    def of(cls, start: str | datetime, end: str | datetime) -> Window:
        return cls(as_datetime(start), as_datetime(end))


def window_for(as_of: str | datetime, lookback: timedelta | str) -> Window:
    """The polling window that ends at ``as_of``; ``lookback`` is a span or an object name."""
    span = LOOKBACK[lookback] if isinstance(lookback, str) else lookback
    end = as_datetime(as_of)
    return Window(end - span, end)
