"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import time

from ledgersync.checks import registered
from ledgersync.session import build_session

HEADLINES = (
    "p01_accounting_snapshot",
    "p01_accounting_changes",
    "p01_accounting_merged",
    "p02_collector",
    "p03_contract",
    "p04_alternate_schedule",
    "p06_invoice_lines",
    "p07_notes",
    "p08_applied_payments",
    "p09_scheduled_billables",
    "p10_total_payments",
    "p11_customer",
    "p13_equipment",
    "p16_amortization",
    "p18_tax_detail",
    "p19_journal_export",
    "p20_delinquency",
    "p21_settlement",
    "p22_gross_definition_check",
    "r02_snapshot_diff",
    "r03_keyed_merge",
    "r08_schedule_rollup",
    "j08_interval_least",
    "w02_line_numbers",
    "t01_stream_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = registered()
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm_dir = warm_dir if os.path.isdir(warm_dir) else sf_dir
    for name in ("p01_accounting_changes", "g01_conditional_sums"):  # untimed: load classes and compile hot paths
        found[name].spark(spark, warm_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in HEADLINES:
        began = time.perf_counter()
        found[name].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - began, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
