"""Logical table names -> DataFrames, over files or JDBC."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ledgersync.schemas import LEASE_DDL, parse_ddl


def _norm(name: str) -> str:
    """Compare names regardless of case, underscores and a custom-field suffix."""
    return re.sub(r"_", "", re.sub(r"__c$", "", name.lower()))


def conform(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Select, rename and cast the (column, type) pairs from ``df``.

    ``ContractOid``, ``contract_oid`` and ``ContractOID__c`` all satisfy
    ``contract_oid``; other columns are pruned before the scan.
    """
    by_name: dict[str, list[str]] = {}
    for c in df.columns:
        by_name.setdefault(_norm(c), []).append(c)
    cols, missing, unclear = [], [], []
    for name, kind in columns:
        hits = by_name.get(_norm(name), [])
        if len(hits) != 1:
            (unclear if hits else missing).append(name)
            continue
        cols.append(f"CAST(`{hits[0]}` AS {kind}) AS `{name}`")
    if missing or unclear:
        raise ValueError(f"missing columns {missing}, ambiguous columns {unclear} among {df.columns}")
    return df.selectExpr(*cols)


@dataclass
class TableCatalog:
    """Reads tables below ``root`` unless an override says otherwise.

    An override is a path, a DataFrame, or reader settings
    ``{"format": "jdbc", "options": {...}}``; JDBC options should name
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` so
    that executors read in parallel. ``crm.<object>`` names live below
    ``crm_root`` (stored snapshots of the downstream system). Switching
    environments means another ``root`` or a few overrides, never another query.
    """

    spark: SparkSession
    root: str
    overrides: Mapping[str, Any] = field(default_factory=dict)
    crm_root: str | None = None
    fmt: str = "parquet"
    ddl: Mapping[str, str] = field(default_factory=lambda: dict(LEASE_DDL))
    _tables: dict[str, DataFrame] = field(default_factory=dict, init=False, repr=False)

    def _load(self, name: str) -> DataFrame:
        spec = self.overrides.get(name)
        if isinstance(spec, DataFrame):
            return spec
        if isinstance(spec, Mapping):
            return self.spark.read.format(spec["format"]).options(**spec.get("options", {})).load(spec.get("path"))
        if spec is None:
            if name.startswith("crm."):
                if self.crm_root is None:
                    raise ValueError("this catalog has no crm_root")
                spec = f"{self.crm_root}/{name[4:]}"
            else:
                spec = f"{self.root}/{name}"
        reader = self.spark.read.format(self.fmt)
        if self.fmt == "csv":
            reader = reader.option("header", "true")
        return reader.load(spec)

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """The table ``name`` under its declared column contract (one plan per name and catalog)."""
        if schema is not None:
            return conform(self._load(name), parse_ddl(schema))
        if name not in self._tables:
            self._tables[name] = self._declared(name)
        return self._tables[name]

    def _declared(self, name: str) -> DataFrame:
        df = self._load(name)
        return conform(df, parse_ddl(self.ddl[name])) if name in self.ddl else df
