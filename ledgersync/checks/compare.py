"""Order-insensitive comparison of a Spark result with a SQL answer."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame


def _cell(v: Any) -> str:
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return repr(v)


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df: DataFrame, con: Any, sql: str | None) -> str:
    """``ok ...`` or a description of the first difference."""
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return f"ok rows-only {len(got)}"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    a, b = _rows(df.columns, got), _rows(names, cur.fetchall())
    if a == b:
        return f"ok {len(a)}" + (" EMPTY" if not a else "")
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"DIFF spark {len(a)} sql {len(b)}\n  cols  {sorted(names)}\n  spark {only_a[:2]}\n  sql   {only_b[:2]}"
