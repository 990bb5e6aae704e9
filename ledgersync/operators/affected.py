"""Affected keys: which rows of a result can have changed, given the change times of every contributing table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersync.functions.clock import Window
from ledgersync.functions.predicates import changed_between
from ledgersync.session import stored


@dataclass(frozen=True)
class Hop:
    """One join of the result's flow, walked backwards: rows of ``table`` whose ``by`` is known lead to their ``to``."""

    table: DataFrame
    by: str
    to: str


@dataclass(frozen=True)
class Contribution:
    """A contributing table: rows changed by ``changed`` lead through ``key`` and the hops to keys of the result."""

    table: DataFrame
    changed: str
    key: str
    hops: Sequence[Hop] = ()


def only(df: DataFrame, keys: DataFrame | None, on: str | tuple[str, str]) -> DataFrame:
    """The rows of ``df`` whose key is listed; all without a list. ``on`` is the column, or (column of ``df``, of the list)."""
    if keys is None:
        return df
    left, right = (on, on) if isinstance(on, str) else on
    listed = keys.select(F.col(right).alias("__affected"))
    return df.join(listed, F.col(left) == F.col("__affected"), "left_semi")


def affected_keys(contributions: Sequence[Contribution], window: Window, name: str) -> DataFrame:
    """(``name``): the distinct result keys that some row changed in ``window`` contributes to.

    Change times are filters on the scans; every hop is a semi join of the next table by the keys found so far, so what is
    shuffled are the keys of changed rows and the two key columns of the tables on the way. The keys are stored once, as
    every table of the recomputation is cut by them.
    """
    arms = []
    for c in contributions:
        found, key = changed_between(c.table, c.changed, window).select(c.key), c.key
        for hop in c.hops:
            found = only(hop.table.select(hop.by, hop.to), found.distinct(), (hop.by, key)).select(hop.to)
            key = hop.to
        arms.append(found.select(F.col(key).alias(name)))
    return stored(reduce(DataFrame.unionByName, arms).dropna().distinct(), "affected")
