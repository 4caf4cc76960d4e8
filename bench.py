"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (folder), BENCH_CPUS (cores) and BENCH_QUERIES (all, or names) steer the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.registry import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "op_group_agg", "op_count_distinct", "op_dedup_latest", "op_merge_upsert", "op_delete_insert", "op_group_by_marker", "op_ffill", "op_running_sum", "op_join_range", "op_join_nearest_preceding",
    "op_join_hour", "op_join_regex_descendant", "op_kv_pivot_map", "op_rolling_window_agg", "op_hex_to_int", "op_symmetric_diff", "op_heal_nulls", "op_stream_tumbling_hour",
    "chain_msgs", "chain_transfers_hourly", "chain_metrics_hourly", "evm_event_logs", "evm_token_transfers", "evm_traces", "evm_nft_transfers", "worklist_logs_to_decode", "dq_profile",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else [n for n in HEADLINE if n in QUERIES]
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()
    took = {}
    for name in names:
        start = time.time()
        try:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took[name] = round(time.time() - start, 3)
        except Exception as e:  # noqa: BLE001
            print(f"{name}: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            took[name] = None
    total = round(sum(v for v in took.values() if v is not None), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": took, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
