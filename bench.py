"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores. Every query runs in full into a sink that keeps nothing; the best
of BENCH_RUNS (default 2) runs counts, so one-off code generation does not.
Whole runs against the state tables (``*_phase``) are timed once.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from drives import QUERIES  # noqa: E402
from estatelake.session import build_session  # noqa: E402

HEADLINE = (
    "new_links", "removed_links", "link_status", "registry_after_delete", "offers_deactivated",
    "retry_pending", "stage_flags", "nav_hrefs", "list_offers", "longest_script", "json_scalars",
    "block_text", "kv_o", "price_text_o", "strip_styling", "description_chunks", "language_chunks",
    "wrapped_descriptions", "details_o", "details_m", "canonical_o", "canonical_m", "offers_all",
    "width_report", "offer_phase",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for _ in range(1 if name.endswith("_phase") else runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(min(taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
