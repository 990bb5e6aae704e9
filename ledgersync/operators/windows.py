"""Row numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.operators.sets import ordered_within
from ledgersync.session import stored


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; ``order`` must be total, so that reruns agree.

    Spark keeps one row per key and task before the shuffle, so hot keys stay cheap.
    """
    if not order:
        raise ValueError("an order with a tie-breaker is required")
    numbered = df.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col("__rn") == 1).drop("__rn")


def number_lines(df: DataFrame, part: str, order: Sequence[str], name: str = "line_no", spread: int = 1) -> DataFrame:
    """Dense line numbers inside ``part`` in ``order`` (NULLs first, order must be total).

    With ``spread`` > 0 the rows are laid out once in ranges of (part, order) in the shared scratch folder, so ``df`` is
    computed once and a part of any size lies in many ranges. Rows are numbered inside their range and shifted by the
    rows of their part in the ranges before; only one count for each part and range passes through a window over the part.
    """
    if spread <= 0:
        return df.withColumn(name, F.row_number().over(W.partitionBy(part).orderBy(*[F.col(c).asc_nulls_first() for c in order])))
    laid = stored(ordered_within(df, part, order).withColumn("__range", F.spark_partition_id()), "numbered")
    counts = laid.groupBy(F.col(part).alias("__part"), F.col("__range").alias("__of")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy("__part").orderBy("__of").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select("__part", "__of", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    inner = W.partitionBy(part, "__range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    numbered = laid.withColumn("__in", F.row_number().over(inner))
    joined = numbered.join(shifts, (F.col("__range") == F.col("__of")) & F.col(part).eqNullSafe(F.col("__part")))
    return joined.withColumn(name, F.col("__in") + F.col("__shift")).drop("__in", "__shift", "__range", "__of", "__part")
