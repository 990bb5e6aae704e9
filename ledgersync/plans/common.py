"""Shared pieces of the extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgersync.operators.affected import only
from ledgersync.operators.sync import eav_resolve
from ledgersync.sources.catalog import TableCatalog


def with_opportunity(
    df: DataFrame, cat: TableCatalog, key: str = "contract_oid", how: str = "inner", listed: DataFrame | None = None
) -> DataFrame:
    """Add the opportunity id; the inner form keeps only rows whose contract has the attribute.

    ``listed`` names the contracts that can occur, so that only their attribute rows are read and de-duplicated.
    """
    values = only(cat.read("generic_value"), listed, ("ref_oid", key))
    return eav_resolve(cat.read("generic_field"), values, df, base_key=key, how=how)
