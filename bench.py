"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "gl_classified", "gl_category_counts", "nav_pivot_total", "tv_pivot", "variance_status", "review_table", "timing_bridge", "vtc_unmatched",
    "posting_group_conflicts", "business_line_reclass", "rule_bridges", "ledger_open_items", "customer_open_items", "voucher_issuance",
    "voucher_usage_monthly", "prepayments", "accrued_revenue", "packages_unreconciled", "collection_open_items", "refund_liability",
    "merge_key_overlap", "quality_report", "table_probe", "dataset_fingerprint",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from closewright.checks.queries import runner
    from closewright.session import local_session

    spark = local_session(os.environ.get("BENCH_CPUS", "8"), shuffle_partitions=int(os.environ.get("BENCH_CPUS", "8")), app="bench")
    # Starts the executor threads and the parquet reader once, outside the measured queries.
    runner("scope_account")(spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        runner(name)(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
