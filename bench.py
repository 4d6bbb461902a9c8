"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (cores).
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallyward.queries import registry
from tallyward.session import local_session

HEADLINE = [
    "dedup_latest",
    "monthly_claims_summary",
    "provider_performance",
    "patient_risk_scores",
    "diagnosis_trends",
    "er_dept_summary",
    "network_utilization",
    "payer_denial_analysis",
    "dq_pass",
    "dq_metrics",
    "scd1_apply",
    "scd2_apply",
    "merge_upsert",
    "snapshot_diff",
    "change_feed",
    "as_of_version",
    "patient_risk_score",
    "fact_claims_star",
    "batch_hourly",
    "stream_hourly",
    "vector_topk",
    "rag_context",
    "claim_history_json",
    "zorder_layout",
    "text_search",
    "network_adequacy",
    "stream_scd2",
]


def run(df) -> None:
    """Compute every row and column and keep none."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "*")
    spark = local_session(cores, 8 if cores == "*" else max(2, int(cores)), "bench")
    registry.load_all()
    names = sys.argv[1:] or HEADLINE
    for name in ("monthly_claims_summary", "vector_topk"):  # warm up the JVM and the Python workers
        run(registry.QUERIES[name](spark, folder))
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(registry.QUERIES[name](spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
