"""Comparison with a stored copy by digests of its key buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersync.operators.sync import UNCHANGED, layout_of, snapshot_diff, with_bucket
from ledgersync.session import scratch_path


def _columns(key: str, measures: Sequence[str | tuple[str, str]]) -> list[str]:
    return list(dict.fromkeys([key, *(c for m in measures for c in ((m,) if isinstance(m, str) else m))]))


def _digests(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per bucket: row count and two order-free combinations of 64-bit row hashes."""
    flags = [F.col(c).isNull() for c in columns]  # a hash alone passes over NULL
    row = F.xxhash64(*columns, *flags)
    return rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("total"), F.bit_xor(F.xxhash64(F.lit("second"), *columns, *flags)).alias("mixed")
    )


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}-digests"


def write_digests(spark: SparkSession, path: str, key: str, measures: Sequence[str | tuple[str, str]]) -> None:
    """Store the digests of a ``write_keyed`` folder beside it; to be renewed whenever the folder is."""
    _, columns = layout_of(spark, path, key)
    stored = spark.read.schema(f"{columns}, bucket int").parquet(path)
    _digests(stored, _columns(key, measures)).coalesce(1).write.mode("overwrite").parquet(_folder(path))


def snapshot_diff_stored(
    current: DataFrame, path: str, key: str, measures: Sequence[str | tuple[str, str]], *, null_safe: bool = False, new_rows: bool = False, status: str = "change_status"
) -> DataFrame:
    """``snapshot_diff`` of ``current`` against a ``write_keyed`` folder with digests, reading only the buckets that differ.

    ``current`` is laid out by the folder's buckets once; rows of a bucket whose digests agree with the stored ones are
    unchanged without a look at the stored rows. Columns are compared under the stored types.
    """
    spark = current.sparkSession
    buckets, columns = layout_of(spark, path, key)
    kinds = dict(spark.createDataFrame([], columns).dtypes)
    names = _columns(key, measures)
    typed = current.select(*[F.col(c).cast(kinds[c]).alias(c) if c in names else F.col(c) for c in current.columns])
    laid = scratch_path(spark, "digest-current")
    schema = with_bucket(typed, key, buckets).schema
    with_bucket(typed, key, buckets).repartition("bucket").write.partitionBy("bucket").parquet(laid)
    rows = spark.read.schema(schema).parquet(laid)
    theirs = spark.read.parquet(_folder(path)).select("bucket", F.struct("rows", "total", "mixed").alias("theirs"))
    ours = _digests(rows, names).select("bucket", F.struct("rows", "total", "mixed").alias("ours"))
    differ = ours.join(theirs, "bucket", "full").filter("NOT (ours <=> theirs)")
    touched = [r.bucket for r in differ.select("bucket").collect()]  # at most ``buckets`` numbers
    stored = spark.read.schema(f"{columns}, bucket int").parquet(path).filter(F.col("bucket").isin(touched)).drop("bucket")
    compared = snapshot_diff(rows.filter(F.col("bucket").isin(touched)).drop("bucket"), stored, key, measures, null_safe=null_safe, new_rows=new_rows, status=status)
    same = rows.filter(~F.col("bucket").isin(touched)).drop("bucket").withColumn(status, F.lit(UNCHANGED))
    return compared.unionByName(same)
