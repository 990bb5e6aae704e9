"""Registered queries: a Spark builder, its result columns and the equivalent SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgersync.registry import ObjectSpec
from ledgersync.schemas import STAR_DDL, columns_of
from ledgersync.sources.star import STAR_VIEWS, StarCatalog, view_sql

AS_OF = "2000-01-01 00:00:00"
PREV_AS_OF = "1999-06-01 00:00:00"
START, END = "1999-01-01 00:00:00", "1999-01-31 00:00:00"
MIDDLE = "1999-01-16 00:00:00"
JOURNAL_MONTH = "1998-10-31"
NOTE_START, NOTE_END, NOTE_MIDDLE = "2024-01-05 00:00:00", "2024-01-20 00:00:00", "2024-01-12 00:00:00"

_SPARK = {"ts": "timestamp_ntz"}
_DUCK = {"ts": "TIMESTAMP", "string": "VARCHAR"}
# Column types of the source contracts as the SQL engine names them.
_CONTRACT_TYPES = {"timestamp_ntz": "TIMESTAMP", "string": "VARCHAR"}


@dataclass(frozen=True)
class Query:
    name: str
    schema: tuple[tuple[str, str], ...]
    build: Callable[[StarCatalog], DataFrame]
    sql: str | None = None

    def spark(self, session: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(StarCatalog(session, sf_dir))
        return df.selectExpr(*[f"CAST(`{c}` AS {_SPARK.get(t, t)}) AS `{c}`" for c, t in self.schema])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        cols = ", ".join(f"CAST({c} AS {_DUCK.get(t, t)}) AS {c}" for c, t in self.schema)
        ctes = ", ".join(f"lease_{n} AS ({_typed(n)})" for n in STAR_VIEWS if re.search(rf"\blease_{n}\b", self.sql))
        return f"{'WITH ' + ctes if ctes else ''} SELECT {cols} FROM ({self.sql}) AS answer"


def _typed(name: str) -> str:
    """A lease view under the declared column types."""
    text = view_sql(name).format(**{t: t for t in STAR_DDL})
    cols = [f"CAST({c} AS {_CONTRACT_TYPES.get(kind, kind)}) AS {c}" for c, kind in columns_of(name)]
    return f"SELECT {', '.join(cols)} FROM ({text}) AS raw"


class Registry:
    """Collects queries by name."""

    def __init__(self) -> None:
        self.items: dict[str, Query] = {}

    def add(self, name: str, schema: str, build: Callable[[StarCatalog], DataFrame], sql: str | None = None) -> None:
        if name in self.items:
            raise ValueError(f"{name} registered twice")
        pairs = tuple(tuple(p.split()) for p in schema.split(","))
        self.items[name] = Query(name, pairs, build, sql)  # type: ignore[arg-type]


def merge_sql(target: str, source: str, spec: ObjectSpec, defaults: bool = True) -> str:
    """The expected result of a keyed upsert as a full join."""
    cols = []
    for c in spec.columns:
        new = f"COALESCE(s.{c}, {spec.defaults[c]})" if defaults and c in spec.defaults else f"s.{c}"
        matched = new if c in spec.update_columns else f"t.{c}"
        cols.append(f"CASE WHEN t.in_t IS NULL THEN {new} WHEN s.in_s IS NULL THEN t.{c} ELSE {matched} END AS {c}")
    return f"""SELECT {', '.join(cols)}
      FROM (SELECT *, 1 AS in_t FROM ({target}) AS tt) AS t
      FULL JOIN (SELECT *, 1 AS in_s FROM ({source}) AS ss) AS s ON t.{spec.key} = s.{spec.key}"""
