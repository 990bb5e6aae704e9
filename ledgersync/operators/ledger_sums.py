"""Ledger sums kept up to date: additive partial states per account id, account, process and post month."""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.functions.clock import as_datetime, ts, ts_sql
from ledgersync.operators.aggregates import LEDGER_AMOUNT, bucket_sums, contracts_of, snapshot_buckets
from ledgersync.sources.folders import names_below, remove_folder

STATE_KEYS = ("general_ledger_account_id_oid", "account_id", "process_oid", "post_month")
STATE_DDL = "general_ledger_account_id_oid bigint, account_id string, process_oid bigint, post_month date, amount decimal(28,2), ledger_rows bigint"


def _added(states: DataFrame) -> DataFrame:
    total = states.groupBy(*STATE_KEYS).agg(F.sum("amount").cast("decimal(28,2)").alias("amount"), F.sum("ledger_rows").alias("ledger_rows"))
    return total.filter("ledger_rows <> 0 OR amount <> 0")  # rows taken back leave nothing


def partial_sums(gl: DataFrame, sign: int = 1) -> DataFrame:
    """The additive state of some ledger rows; ``sign`` -1 takes rows back that were added before."""
    month = F.trunc("post_date", "month").alias("post_month")
    sums = gl.groupBy(*STATE_KEYS[:3], month).agg(F.expr(f"SUM({LEDGER_AMOUNT}) AS amount"), F.expr("COUNT(1) AS ledger_rows"))
    signed = {"amount": (F.col("amount") * sign).cast("decimal(28,2)"), "ledger_rows": F.col("ledger_rows") * sign}
    return sums.withColumns(signed).select(*STATE_KEYS, *signed)


class LedgerSums:
    """Stored ledger sums in a folder: a folded base and the batches added since.

    Sums are additive, so batches may come late, in any order, and months long closed may still change. A batch has a run
    name: added again it replaces itself, and once folded it is left out. ``fold`` writes a new base beside the old one and
    then the manifest that names it and its batches; a fold that stops before the manifest changes nothing. Bases and
    batches of the fold before last are removed. One job at a time may add or fold.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _manifest(self) -> tuple[int, str | None, list[str]]:
        turns = names_below(self.spark, f"{self.path}/manifests", "turn=")
        for turn in sorted(map(int, turns), reverse=True):
            if rows := self.spark.read.schema("base string, folded array<string>").parquet(f"{self.path}/manifests/turn={turn}").take(1):
                return turn, rows[0].base, rows[0].folded
        return 0, None, []

    def add(self, gl: DataFrame, run: str, sign: int = 1) -> None:
        """Add the ledger rows ``gl`` (or take them back) as the batch named ``run``."""
        name = hashlib.sha256(run.encode()).hexdigest()[:16]
        if name not in self._manifest()[2]:
            partial_sums(gl, sign).write.mode("overwrite").parquet(f"{self.path}/batches/batch={name}")

    def _states(self, base: str | None, batches: list[str]) -> DataFrame:
        paths = [*([base] if base else []), *[f"{self.path}/batches/batch={b}" for b in batches]]
        return self.spark.read.schema(STATE_DDL).parquet(*paths) if paths else self.spark.createDataFrame([], STATE_DDL)

    def sums(self) -> DataFrame:
        """The sums of all batches added so far, one row per key."""
        _, base, folded = self._manifest()
        pending = [b for b in names_below(self.spark, f"{self.path}/batches", "batch=") if b not in folded]
        return _added(self._states(base, pending))

    def fold(self) -> None:
        """Merge the batches into a new base, so that readers open one folder again."""
        turn, base, folded = self._manifest()
        there = names_below(self.spark, f"{self.path}/batches", "batch=")
        pending = [b for b in there if b not in folded]
        if not pending:
            return
        new = f"{self.path}/base-{uuid.uuid4().hex}"
        _added(self._states(base, pending)).write.parquet(new)
        named = self.spark.createDataFrame([(new, [*folded, *pending])], "base string, folded array<string>").coalesce(1)
        named.write.mode("overwrite").parquet(f"{self.path}/manifests/turn={turn + 1}")
        for b in there:
            if b in folded:  # folded the time before, so readers of that time are gone
                remove_folder(self.spark, f"{self.path}/batches/batch={b}")
        if turn > 1:
            old = self.spark.read.parquet(f"{self.path}/manifests/turn={turn - 1}").first()
            remove_folder(self.spark, old.base)
            remove_folder(self.spark, f"{self.path}/manifests/turn={turn - 1}")


def reduced_from_sums(sums: DataFrame, gl: DataFrame, as_of: str | datetime) -> DataFrame:
    """The ledger at ``as_of`` as (account id, account, process, posted, amount, ledger_rows): stored sums of all months but
    the open one, whose rows are read from the ledger (a filter on the post date that reaches the scan)."""
    now = as_datetime(as_of)
    month = datetime(now.year, now.month, 1)
    after = datetime(now.year + now.month // 12, now.month % 12 + 1, 1)
    is_open = f"post_month = DATE'{month:%Y-%m-%d}'"
    closed = sums.filter(f"NOT COALESCE({is_open}, FALSE)").withColumn("posted", F.expr(f"post_month < DATE'{month:%Y-%m-%d}'"))
    open_rows = gl.filter((F.col("post_date") >= ts(month)) & (F.col("post_date") < ts(after)))
    now_open = open_rows.groupBy(*STATE_KEYS[:3], F.expr(f"post_date <= {ts_sql(as_of)} AS posted")).agg(
        F.expr(f"SUM({LEDGER_AMOUNT}) AS amount"), F.expr("COUNT(1) AS ledger_rows")
    )
    columns = [*STATE_KEYS[:3], "posted", "amount", "ledger_rows"]
    return closed.select(*columns).unionByName(now_open.select(*columns))


def ledger_series(gl: DataFrame, account_ids: DataFrame, dates: list[str | datetime]) -> DataFrame:
    """(as_of, contract_oid, balances): ``ledger_snapshot`` for each of ``dates``, from one pass over the ledger.

    A ledger row changes the balances from the first date on that is not before its post date. Changes are summed per
    contract and date, added up by a window over a contract's few dates, and carried on to the dates without changes.
    """
    days = sorted({as_datetime(d) for d in dates})
    calendar = F.array(*[ts(d) for d in days])
    first = F.size(F.filter(calendar, lambda d: d < F.col("post_date"))).alias("nth")
    posted = gl.filter(F.col("post_date") <= ts(days[-1]))
    reduced = posted.groupBy(*STATE_KEYS[:3], first).agg(F.expr(f"SUM({LEDGER_AMOUNT}) AS amount"))
    buckets = snapshot_buckets()
    changes = bucket_sums(reduced.join(contracts_of(account_ids), STATE_KEYS[0]), ["contract_oid", "nth"], "amount", buckets)
    own = W.partitionBy("contract_oid").orderBy("nth")
    so_far = own.rowsBetween(W.unboundedPreceding, W.currentRow)
    running = changes.select("contract_oid", "nth", F.lead("nth", 1, len(days)).over(own).alias("until"), *[F.sum(b.name).over(so_far).alias(b.name) for b in buckets])
    each = running.withColumn("nth", F.explode(F.sequence(F.col("nth"), F.col("until") - 1)))
    out = each.select(F.element_at(calendar, F.col("nth") + 1).alias("as_of"), "contract_oid", *[b.name for b in buckets])
    return out.withColumn("original_gross_receivable", F.coalesce("original_gross_receivable", F.lit(0)))
