"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up; the median is reported
BENCH_QUERIES  comma-separated query names, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelweave.session import build_session  # noqa: E402
from panelweave.suite import QUERIES  # noqa: E402

HEADLINE = [
    "diff_by_year",
    "diff_snapshots",
    "diff_detail",
    "diff_all_pairs",
    "diff_release_table",
    "diff_harmonised_snapshots",
    "diff_headline",
    "top_added_entities",
    "duplicate_keys",
    "keep_newest_edition",
    "raw_snapshot_normalized",
    "indicator_snapshot",
    "unpivot_keep_null",
    "unpivot_drop_null",
    "natural_left_join_3way",
    "tidy_wide_sheets",
    "tidy_entity_files",
    "normalize_codes",
    "classify_stage",
    "classify_explode",
    "lookup_matched_rows",
    "lookup_coverage_gate",
    "manifest_merge",
    "manifest_upsert",
    "consecutive_pairs",
    "entity_coverage_gate",
    "entity_frequency_all",
    "count_by_type_source",
    "share_within_year",
    "component_max",
    "topk_entities",
    "subset_with_groups",
    "first_valid_capture",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE

    spark = build_session(
        "panelweave-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="panelweave-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:] or timings), 4)

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "runs": runs,
                "spark": spark.version,
                "shuffle_partitions": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
