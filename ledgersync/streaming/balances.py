"""Balances kept by a stateful streaming aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgersync.operators.aggregates import LEDGER_AMOUNT, Bucket, bucket_sums, contracts_of
from ledgersync.operators.sync import append_changes, keyed_state
from ledgersync.registry import ObjectSpec
from ledgersync.streaming.upsert import empty_target

VERSION = "version"


def balance_spec(buckets: Sequence[Bucket]) -> ObjectSpec:
    """How the balances are stored: one row per contract, the newest version counts."""
    names = ["contract_oid", *[b.name for b in buckets], VERSION]
    return ObjectSpec("balances", "contract_oid", {n: n for n in names})


def balance_ddl(buckets: Sequence[Bucket]) -> str:
    return ", ".join(["contract_oid bigint", *[f"{b.name} decimal(38,2)" for b in buckets], f"{VERSION} bigint"])


def stream_balances(ledger: DataFrame, account_ids: DataFrame, buckets: Sequence[Bucket], target: str, checkpoint: str) -> StreamingQuery:
    """Start the aggregation of a stream of ledger rows into a folder made by ``empty_balances``.

    Sums live in the state store, one entry per contract, and are recovered from the checkpoint. There is no watermark:
    a row counts however late it comes, and a reversal is a row with the opposite amount. A micro-batch emits the
    contracts it changed (update mode) and appends them with its number as version; a batch that runs again replaces
    itself. For many contracts let the session use the RocksDB state store.
    """
    rows = ledger.selectExpr("general_ledger_account_id_oid", "account_id", "process_oid", f"CAST({LEDGER_AMOUNT} AS DECIMAL(18,2)) AS amount")
    known = rows.join(contracts_of(account_ids), "general_ledger_account_id_oid")
    sums = bucket_sums(known, ["contract_oid"], "amount", buckets)
    spec = balance_spec(buckets)

    def append(batch: DataFrame, batch_id: int) -> None:
        versioned = batch.select("contract_oid", *[F.col(b.name).cast("decimal(38,2)").alias(b.name) for b in buckets], F.lit(batch_id).cast("long").alias(VERSION))
        append_changes(versioned, target, spec, f"{checkpoint.rstrip('/')}#{batch_id}", latest_by=[VERSION])

    return sums.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def empty_balances(spark: SparkSession, target: str, buckets: Sequence[Bucket], n: int = 64) -> None:
    empty_target(spark, target, balance_ddl(buckets), "contract_oid", n)


def current_balances(spark: SparkSession, target: str, buckets: Sequence[Bucket]) -> DataFrame:
    """The balances as of the last finished micro-batch."""
    return keyed_state(spark, target, balance_spec(buckets), balance_ddl(buckets), [VERSION]).drop(VERSION)
