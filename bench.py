"""Times the headline queries, each on its second run, and prints one JSON line.

BENCH_SF_DIR is the table directory, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import pathlib
import re
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from snapmart.driver import registry  # noqa: E402
from snapmart.session import local_session  # noqa: E402

HEADLINE = (
    "scan_project_cast",
    "dedup_latest",
    "stg_observations",
    "int_enriched",
    "int_lifecycle",
    "dim_video",
    "fct_daily",
    "mart_channel_performance",
    "mart_category_performance",
    "mart_regional_trending",
    "dq_not_null",
    "dq_unique",
    "dq_orphan_category",
    "profile_counts",
    "profile_duplicates",
    "profile_parse_failures",
    "profile_title_changes",
    "profile_cross_region",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries = registry.queries()
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        # the no-op sink computes every row and column, without a result on the driver
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in names:  # class loading, code generation, JIT
        run(name)
    seconds = {name: run(name) for name in names}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
