"""Unions and orderings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_arms(*arms: DataFrame) -> DataFrame:
    """All rows of all arms, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), arms)


def ordered(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Delivered order: a range-partitioned total sort, NULLs first."""
    return df.orderBy(*[F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols])


def ordered_within(df: DataFrame, part: str, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Files ordered by ``part`` and ``cols``, with range partitions that split a hot part."""
    keys = [F.col(c).asc_nulls_first() for c in (part, *cols)]
    spread = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*keys)
