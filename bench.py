"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) names the tables, ``BENCH_CPUS``
(default: all cores) the local cores. Every query runs twice, in full, into a
sink that discards its rows; the second time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from courtlake.session import build_session
import harness.queries  # noqa: F401  registers everything
from harness.registry import QUERIES

HEADLINES = [
    "season_totals", "dedupe_first", "duplicate_count", "first_stub_wins", "last_load_wins",
    "fk_filter", "fk_rejects", "upsert_counts", "upsert", "upsert_key_only", "insert_if_absent",
    "decimal_minutes", "clock_seconds", "coerce_long", "typed_store", "scan_manifest",
    "manifest_join", "decode_resultset", "flatten_nested", "boxscore_rows", "play_rows",
    "shot_rows", "check_pk_unique", "contract_of_lines", "contract_boxscore", "validation_report",
    "write_partitioned", "ordered_layout", "date_breakdown", "backfill_summary", "build_silver",
    "load_facts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    only = sys.argv[1:] or HEADLINES
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for key in only:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[key] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, second run, wall time", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
