"""Seconds per headline query, as one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS]. Each query
is run to the end through the no-op sink with the tables' own types, so nothing is
left out, collected or formatted. The extracts, which stand for the source tables, are
loaded first and timed apart (``loading``); so are the tables that several queries read
(``storing``): applications, loans, payment history, rate curves, and plan and paid days in
buckets. A query's time is what it takes on top of them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loanloom.catalog import REGISTERED  # noqa: E402
from loanloom.catalog.lending import extracts, lending, release  # noqa: E402
from loanloom.session import local_session  # noqa: E402

HEADLINE = (
    "q1_applications_approval",
    "q2_loans_gmv",
    "q3_cohort_gmv",
    "q4_fpd30",
    "q5_par30_balance",
    "q6_merchant_concentration",
    "q7_redundant_ids",
    "fct_application",
    "fct_loan",
    "int_payment_history",
    "int_installment_status",
    "fct_installment_status",
    "dm_loan_delinquency_snapshot",
    "agg_merchant_monthly",
    "effective_at_cutoff",
    "fifo_settlement",
    "running_paid_ranges",
    "asof_fx",
    "scd2_join",
    "dq_fifo_conservation",
    "triage_results",
    "triage_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = sys.argv[1:] or HEADLINE
    partitions = int(cpus) if cpus.isdigit() else 8
    spark = local_session("bench", cpus, shuffle_partitions=partitions, memory="16g")
    # Start-up of the JVM and its code paths is not part of any query.
    spark.read.parquet(f"{folder}/orders.parquet").write.format("noop").mode(
        "overwrite"
    ).save()
    start = time.perf_counter()
    raw = extracts(spark, folder)
    for name in raw:
        raw[name]
    loading = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    lending(spark, folder).store()
    storing = round(time.perf_counter() - start, 3)
    print("loading", loading, "storing", storing, file=sys.stderr)
    seconds: dict[str, float] = {}
    for name in wanted:
        start = time.perf_counter()
        REGISTERED[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    release()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "loading": loading,
                "storing": storing,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
